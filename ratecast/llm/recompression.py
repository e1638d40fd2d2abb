"""Substring deduplication by recompression: repeats of LENGTH words, whichever documents they lie in.

Every document is parsed in rounds. A round names runs and pairs of neighbouring symbols: a symbol
flips a coin by its name, and a boundary between two symbols goes if they are equal or if
the left one's coin is 0 and the right one's is 1; so a run, a pair, or a run of one followed by a run of another becomes one
symbol, named by what it holds. Names are 64-bit hashes of that content, hence the same in
all tasks without a shared dictionary, and every round of every document uses the
same names. A symbol's identity depends on itself and the neighbours that were looked at; these words are tracked exactly as
its context. Equal strings of words therefore have the same symbols, of all rounds, wherever the context lies within
the string.

Of the symbols whose context lies in a window of LENGTH words, the window's anchor is one of the
highest round, of these the one with the least name, of these the first: a function of the
window's words alone. So windows can only be equal if they have the same anchor at the same place.
Consecutive windows with the same anchor form a stretch, about one in ten words. Stretches are dealt by the anchor's name
and context, so all occurrences of a repeat meet, and are sorted by a second, independent hash of all their words:

* a stretch that also is in a document of smaller id is covered whole;
* where a symbol is shared by stretches that differ, the windows of the first of each
  kind are hashed by their words (128 bits), dealt by that hash, and covered in all but the least document.

Of equal stretches (or windows) of one block of texts in different documents only the first is
dealt by its name, so a passage that a third of all documents share is a row a block. Whole copies of
a text are found by the text's hash and only the first is parsed (in each task). Nothing is ever compared pair by pair.

Order: ``doc_id``, null last. A window is removed if the same words start a window in a document of smaller
id; equal ids (and two nulls) are not smaller, whatever their texts.

Defined cases: a null text has no words; a text of fewer than LENGTH words has no
window and stays; repeated rows are each returned with the same result; columns not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.llm.bytes_hash import Substrings, blocks, mix, runs
from ratecast.llm.common import partitions, stored

LENGTH = 50
LAST = 2 ** 63 - 1
#: Fixed value: rounds after which no symbol's context fits a window of LENGTH words, in practice; more change nothing.
ROUNDS = 8
#: Fixed values of the names: odd multipliers.
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
#: A text of more bytes is parsed in pieces of so many windows.
PIECE_BYTES, PIECE_WORDS = 1 << 20, 1 << 17
#: Texts whose hashes a task remembers to leave out whole copies.
REMEMBERED = 500_000


def keyed_by_order(docs: DataFrame) -> DataFrame:
    """``doc_id, ord, key, text``: ord is the id with null last, key a hash that tells texts of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"),
                       F.xxhash64(text).alias("key"), text.alias("text"))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of a block; the byte between two texts is no part of a word."""
    return runs((data != 0x20) & ((data < 9) | (data > 13)))


def words_of_block(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of a block's words; ``first[i]`` is the number of the first word of text i, one more at the end."""
    inside = (data != 0x20) & ((data < 9) | (data > 13))
    inside[offsets[1:] - 1] = False
    start, end = runs(inside)
    return start, end, np.searchsorted(start, offsets)


# the parse


class Symbols:
    """The symbols of one round over a block of texts, in order: words [start, end), context [low, high), name, text."""

    def __init__(self, start, end, low, high, name, text):
        self.start, self.end, self.low, self.high, self.name, self.text = start, end, low, high, name, text


def words_as_symbols(names: np.ndarray, text: np.ndarray) -> Symbols:
    at = np.arange(len(names))
    return Symbols(at, at + 1, at, at + 1, names, text)


def next_round(s: Symbols, number: int) -> Symbols:
    """Runs and pairs become symbols; symbols of different texts never join."""
    n = len(s.name)
    seed = np.uint64((int(ODD[0]) * (2 * number + 1)) % 2 ** 64)
    coin = (mix(s.name + seed) >> np.uint64(40)) & np.uint64(1)
    same_text = s.text[1:] == s.text[:-1]
    joins = same_text & ((s.name[1:] == s.name[:-1]) | ((coin[:-1] == 0) & (coin[1:] == 1)))
    first = np.flatnonzero(np.concatenate(([True], ~joins)))
    last = np.concatenate((first[1:], [n])) - 1
    # a group is a run of one name, or such a run and a run of another: named by both and their lengths
    in_run = np.concatenate(([False], joins & (s.name[1:] == s.name[:-1])))
    group = np.cumsum(np.concatenate(([True], ~joins))) - 1
    size = last - first + 1
    turn = np.flatnonzero(~in_run & (np.arange(n) != first[group]))  # where the second run begins
    head = size.copy()
    head[group[turn]] = turn - first[group[turn]]
    tail = size - head
    x, y = s.name[first], np.where(tail > 0, s.name[last], np.uint64(0))
    name = mix(x * ODD[1] + head.astype(np.uint64) * ODD[2] + mix(y + tail.astype(np.uint64) * ODD[3]))
    name = np.where(size == 1, x, name)
    # what the boundaries depend on: the symbols on both sides, if they are of the same text
    before = np.where((first > 0) & (s.text[first - 1] == s.text[first]), first - 1, first)
    after = np.minimum(last + 1, n - 1)
    after = np.where(s.text[after] == s.text[last], after, last)
    return Symbols(s.start[first], s.end[last], s.low[before], s.high[after], name, s.text[first])


def anchors(names: np.ndarray, text: np.ndarray, first: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(word that the window starts with, anchor's first word, its name, its context's begin and end) of every window of a block, in order."""
    size = np.diff(first)
    n_windows = np.maximum(size - length + 1, 0)
    window = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + np.repeat(first[:-1], n_windows)
    at, name = np.full(len(window), -1), np.zeros(len(window), np.uint64)
    low, high = np.zeros(len(window), np.int64), np.zeros(len(window), np.int64)
    levels = [words_as_symbols(names, text)]
    while len(levels) <= ROUNDS:
        levels.append(next_round(levels[-1], len(levels)))
        _open_at_borders(levels[-1], first)
    todo = np.arange(len(window))
    for s in reversed(levels):
        w = window[todo]
        lo = np.searchsorted(s.low, w, "left")  # the first symbol whose context begins in the window
        hi = np.searchsorted(s.high, w + length, "right")  # after the last whose context ends in it
        some = hi > lo
        best = _least(s.name, lo[some], hi[some])
        got = todo[some]
        at[got], name[got], low[got], high[got] = s.start[best], s.name[best], s.low[best], s.high[best]
        todo = todo[~some]
        if not todo.size:
            break
    return window, at, name, low, high


def _open_at_borders(s: Symbols, first: np.ndarray) -> None:
    """A symbol at a text's border was made without a neighbour there, as it would not be elsewhere: no window holds its context."""
    at_start = np.concatenate(([True], s.text[1:] != s.text[:-1]))
    at_end = np.concatenate((s.text[1:] != s.text[:-1], [True]))
    s.low = np.where(at_start, np.minimum(s.low, first[s.text] - 1), s.low)
    s.high = np.where(at_end, np.maximum(s.high, first[s.text + 1] + 1), s.high)


def _least(name: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Position of the least name in each range [lo, hi), the first of equals; ranges are not empty."""
    if not lo.size:
        return lo
    widest = int((hi - lo).max())
    table = [np.arange(len(name))]
    while 2 ** len(table) <= widest:
        a, step = table[-1], 2 ** (len(table) - 1)
        b = np.concatenate((a[step:], np.full(step, len(name) - 1)))
        table.append(np.where(name[b] < name[a], b, a))
    k = np.floor(np.log2(hi - lo)).astype(np.int64)
    out = np.empty(len(lo), np.int64)
    for i, t in enumerate(table):
        some = np.flatnonzero(k == i)
        a, b = t[lo[some]], t[hi[some] - 2 ** i]
        out[some] = np.where(name[b] < name[a], b, a)
    return out


class Texts:
    """A block of texts as words: two independent hashes of each word and of every string of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        start, end, self.first = words_of_block(data, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.names = Substrings(data)(start, end)
        self.strings = [_Strings(self.names), _Strings(Substrings(data, seed=1)(start, end))]


class _Strings:
    """Hashes of strings of words [start, end), from running sums as for bytes."""

    def __init__(self, words: np.ndarray):
        base = int(ODD[1])
        n = len(words) + 1
        up, down = (np.full(n, x, np.uint64) for x in (base, pow(base, -1, 2 ** 64)))
        up[0] = down[0] = 1
        up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(words * up[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """(number of the first word, bytes) of the pieces of a long text; a window lies whole in exactly one.

    Anchors depend on their window's words alone, so the cuts change none.
    """
    if len(raw) <= PIECE_BYTES:
        yield 0, raw
        return
    start, end = words_of(np.frombuffer(raw, np.uint8))
    for a in range(0, max(len(start) - LENGTH + 1, 1), PIECE_WORDS):
        yield a, raw[start[a]:end[min(a + PIECE_WORDS + LENGTH - 1, len(start)) - 1]] if len(start) else b""


# the Spark stages

STRETCHES = "name long, whole long, ord long, key long, start int, size int, later boolean"


def stretches(docs: DataFrame) -> DataFrame:
    """Every stretch: anchor's name, hash of its words and the anchor's place, document, first word, number of words.

    ``later``: an equal stretch of a smaller document lies in the same block; such a row is dealt anywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int]] = {}
        for b in batches:
            texts, ids = [], []
            for o, k, s in zip(b.column("ord").to_pylist(), b.column("key").to_pylist(), b.column("text").to_pylist()):
                raw = s.encode()
                if len(raw) < 2 * LENGTH - 1:
                    continue
                digest = hashlib.blake2b(raw, digest_size=16).digest()
                if seen.get(digest, (LAST, 0))[0] < o or seen.get(digest) == (o, k):
                    continue  # a copy of an earlier document, or the same row again
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen[digest] = (o, k)
                for first_word, piece in pieces(raw):
                    texts.append(piece)
                    ids.append((o, k, first_word))
            who = np.array(ids, np.int64).reshape(-1, 3)
            for base, data, offsets in blocks(texts):
                t = Texts(data, offsets)
                window, at, name, low, high = anchors(t.names, t.text, t.first)
                if not len(window):
                    continue
                text = t.text[window]
                new = np.concatenate(([True], (at[1:] != at[:-1]) | (name[1:] != name[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
                                               | (text[1:] != text[:-1])))
                lo = np.flatnonzero(new)
                hi = np.concatenate((lo[1:], [len(window)])) - 1
                start, end = window[lo], window[hi] + LENGTH
                whole = mix(t.strings[1](start, end) + (at[lo] - start).astype(np.uint64) * ODD[2])
                # the symbol and the words that fixed it: they lie in each of its windows
                gram = mix(t.strings[0](low[lo], high[lo]) + name[lo] * ODD[2] + (at[lo] - low[lo]).astype(np.uint64) * ODD[3])
                doc = who[base + text[lo]]
                later = _first_in_block([whole, gram], doc[:, 0])
                gram[later] = mix(gram[later] + start[later].astype(np.uint64) + doc[later, 1].view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(np.ascontiguousarray(doc[:, 0])),
                     pa.array(np.ascontiguousarray(doc[:, 1])), pa.array((start - t.first[text[lo]] + doc[:, 2]).astype(np.int32)),
                     pa.array((end - start).astype(np.int32)), pa.array(later)],
                    names=["name", "whole", "ord", "key", "start", "size", "later"])

    return docs.select("ord", "key", "text").mapInArrow(run, STRETCHES)


#: kind 0: covered whole. 1: the first document's, in a bucket that holds other stretches too.
FOUND = "kind int, ord long, key long, start int, size int"


def _met(rows: DataFrame) -> DataFrame:
    """From rows sorted by (name, whole, ord): what is covered or must be looked at. Holds the first document's stretches of one kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = ("ord", "key", "start", "size")

        def out(kind: int, a: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(np.ascontiguousarray(a[:, 0])), pa.array(np.ascontiguousarray(a[:, 1])),
                                               pa.array(a[:, 2].astype(np.int32)), pa.array(a[:, 3].astype(np.int32))], names=["kind", *cols])

        name = whole = least = None  # of the row before
        mixed_before = False  # the open bucket has more than one kind
        held: list[np.ndarray] = []  # else: the first document's rows of its only kind
        for b in batches:
            a = np.column_stack([b.column(c).to_numpy().astype(np.int64) for c in ("name", "whole", *cols)])
            late = b.column("later").to_numpy(zero_copy_only=False)
            if late.any():
                yield out(0, a[late][:, 2:])
                a = a[~late]
            if not len(a):
                continue
            new_name = np.concatenate(([name is None or a[0, 0] != name], a[1:, 0] != a[:-1, 0]))
            new = new_name | np.concatenate(([a[0, 1] != whole], a[1:, 1] != a[:-1, 1]))
            first_ord = np.concatenate(([0 if least is None else least], a[new, 2]))[np.cumsum(new)]
            covered = a[:, 2] > first_ord
            if covered.any():
                yield out(0, a[covered][:, 2:])
            bucket = np.cumsum(new_name)  # 0: the open one
            kinds = np.bincount(bucket[new], minlength=int(bucket[-1]) + 1)
            kinds[0] += 2 if mixed_before else 1
            mixed = kinds > 1
            if bucket[0] == 0 and mixed[0] and held:
                yield out(1, np.concatenate(held))
                held = []
            look = ~covered & mixed[bucket]
            if look.any():
                yield out(1, a[look][:, 2:])
            if bucket[-1] > 0:
                held = []
            mixed_before = bool(mixed[-1])
            if not mixed_before:
                held.append(a[(bucket == bucket[-1]) & ~covered][:, 2:])
            name, whole, least = a[-1, 0], a[-1, 1], first_ord[-1]

    return rows.mapInArrow(run, FOUND)


def _first_in_block(keys: list[np.ndarray], ord_: np.ndarray) -> np.ndarray:
    """Whether an equal key with a smaller ``ord`` is in the block, for each row."""
    order = np.lexsort((ord_, *keys))
    o = ord_[order]
    opens = np.zeros(len(order), bool)
    opens[:1] = True
    for k in keys:
        opens[1:] |= k[order][1:] != k[order][:-1]
    later = np.zeros(len(order), bool)
    later[order] = o > o[np.flatnonzero(opens)][np.cumsum(opens) - 1]
    return later


def _windows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``w0, w1, ord, key, start, later`` of all windows of the stretches to look at."""
    wanted = found.groupBy("ord", "key").agg(F.collect_set(F.struct("start", "size")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for b in batches:
            some = []
            for i, (o, k) in enumerate(zip(b.column("ord").to_pylist(), b.column("key").to_pylist())):
                if (o, k) != before:  # else the same row again
                    some.append(i)
                before = (o, k)
            b = b.take(pa.array(some, pa.int64()))
            o, k = b.column("ord").to_numpy(), b.column("key").to_numpy()
            asked = b.column("wanted").to_pylist()
            for base, data, offsets in blocks(x.encode() for x in b.column("text").to_pylist()):
                t = Texts(data, offsets)
                rows = [(i, w["start"], w["size"]) for i in range(len(offsets) - 1) for w in asked[base + i]]
                text, start, size = np.array(rows, np.int64).reshape(-1, 3).T
                n = size - LENGTH + 1
                at = np.repeat(t.first[text] + start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.unique(at)
                text = t.text[at]
                w0, w1 = (h(at, at + LENGTH) for h in t.strings)
                later = _first_in_block([w1, w0], o[base + text])
                w0[later] = mix(w0[later] + at[later].astype(np.uint64) + k[base + text[later]].view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w0.view(np.int64)), pa.array(w1.view(np.int64)), pa.array(o[base + text]), pa.array(k[base + text]),
                     pa.array((at - t.first[text]).astype(np.int32)), pa.array(later)], names=["w0", "w1", "ord", "key", "start", "later"])

    return (docs.join(wanted, ["ord", "key"]).select("ord", "key", "text", "wanted")
            .mapInArrow(run, "w0 long, w1 long, ord long, key long, start int, later boolean"))


def _later(rows: DataFrame) -> DataFrame:
    """From rows sorted by (w0, w1, ord): the windows that are not of their first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = least = None
        for b in batches:
            out = b.column("later").to_numpy(zero_copy_only=False).copy()
            at = np.flatnonzero(~out)
            if at.size:
                w = np.column_stack([b.column(c).to_numpy()[at] for c in ("w0", "w1")])
                o = b.column("ord").to_numpy()[at]
                new = np.concatenate(([last is None or (w[0] != last).any()], (w[1:] != w[:-1]).any(1)))
                first = np.concatenate(([0 if least is None else least], o[new]))[np.cumsum(new)]
                out[at] = o > first
                last, least = w[-1], first[-1]
            if out.any():
                yield b.filter(pa.array(out)).select(["ord", "key", "start"])

    return rows.mapInArrow(run, "ord long, key long, start int")


def whole_copies(docs: DataFrame) -> DataFrame:
    """``ord, key, start, size`` of documents whose text a document of smaller id has; the size is in bytes, so never too small."""
    d = docs.select("ord", "key", F.xxhash64(F.lit("second"), "text").alias("other"), F.octet_length("text").alias("size")).where(F.col("size") >= 2 * LENGTH - 1)
    first = d.groupBy("key", "other").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first != last").drop("last")
    return d.join(first, ["key", "other"]).where("ord != first").select("ord", "key", F.lit(0).alias("start"), F.col("size").cast("int")).distinct()


def covered(docs: DataFrame) -> DataFrame:
    """``ord, key, start, size``: words to remove, overlapping; ``docs`` as from ``keyed_by_order``."""
    n = partitions(docs.sparkSession)
    rows = stretches(docs).repartition(n, "name").sortWithinPartitions("name", "whole", "ord", "key", "start")
    found = stored(_met(rows), "shared_symbols")
    windows = _windows(docs, found.where("kind = 1")).repartition(n, "w0").sortWithinPartitions("w0", "w1", "ord")
    later = _later(windows).select("ord", "key", "start", F.lit(LENGTH).alias("size"))
    return (found.where("kind = 0").select("ord", "key", "start", "size").unionByName(later).unionByName(whole_copies(docs)))


DEDUPED = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"


def substring_dedup(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, spans`` (removed runs of words), ``kept`` (words left, joined by one space) per document.

    With ``digest``, ``kept`` is the lowercase hex SHA-256 of that text.
    """
    docs = keyed_by_order(docs)
    spans = covered(docs).groupBy("ord", "key").agg(F.collect_list(F.struct("start", "size")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
        for b in batches:
            rows = []
            for i, s, gone in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                raw = s.encode()
                start, end = words_of(np.frombuffer(raw, np.uint8))
                n = len(start)
                # a copy's size is in bytes; it is covered whole if it has a window at all
                edges = np.zeros(n + 1, np.int64)
                for g in gone or ():
                    if n >= LENGTH:
                        edges[g["start"]] += 1
                        edges[min(g["start"] + g["size"], n)] -= 1
                out = np.cumsum(edges)[:-1] > 0
                lo, hi = runs(out)
                kept = b" ".join(raw[start[w]:end[w]] for w in np.flatnonzero(~out)).decode()
                rows.append((i, n, int(out.sum()), [{"start": int(x), "end": int(y)} for x, y in zip(lo, hi)],
                             hashlib.sha256(kept.encode()).hexdigest() if digest else kept))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return docs.join(spans, ["ord", "key"], "left").select("doc_id", "text", "spans").mapInArrow(run, DEDUPED)


#: The same result in DuckDB, on the words themselves.
SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {LENGTH - 2})) AS i FROM d WHERE len(ws) >= {LENGTH}),
h AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(ws[i:i + {LENGTH - 1}], ' ')) AS m FROM w),
f AS (SELECT m, min(doc_id) AS first FROM h GROUP BY m HAVING min(doc_id) < max(doc_id)),
g AS (SELECT DISTINCT doc_id, i + unnest(range(0, {LENGTH})) AS i FROM h JOIN f USING (m) WHERE doc_id > first),
gone AS (SELECT doc_id, list(i ORDER BY i) AS gs, count(*) AS n FROM g GROUP BY doc_id),
left_over AS (SELECT d.doc_id, ws, coalesce(n, 0) AS n, CASE WHEN gs IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(gs, i)) END AS kept
              FROM d LEFT JOIN gone ON gone.doc_id = d.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, n::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM left_over
"""
