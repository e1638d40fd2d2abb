"""Suffix-array deduplication: maximal repeats by a stack scan of enhanced suffix arrays.

Strings of LENGTH bytes can only be equal if their anchors (see ``anchors``) are, so
suffixes are dealt out by the anchor's gram: a stretch goes to the bucket of its
gram, and all occurrences of a repeat meet there, whatever the documents. Equal
stretches are one string with a first place. In a bucket the suffixes of its
different strings are sorted with their common prefixes into an enhanced
suffix array; a stack scan opens and closes intervals of common prefixes of LENGTH bytes
or more, and an interval is a maximal repeat if the bytes to the left of its
suffixes differ (a string's own beginning counts as different: there another
bucket goes on). Groups hold all occurrences, and every occurrence but the first
is covered over the group's whole length.

Of equal stretches in one block of texts only the first is dealt to its bucket, the
others are known to be later; so a line that a third of all documents repeat
reaches its bucket once per block. A bucket's array is sorted in parts with
different beginnings, so that its memory is bounded. A bucket with more than
SPLIT different strings is split further, by the LENGTH-byte window, which is
aggregated before it is shuffled. Hashes of windows and grams have 64 bits each
and are always compared in pairs.

Order: smaller doc_id first, then earlier start; null ids last. Whole copies of
a text are found by their hash and only their first document's text is taken
apart (once per task).

Defined cases: a null text is empty and has no bytes; equal rows are one
document, each returned; one id with two texts (or null) is as many documents, ordered by a
64-bit hash of the text; strings never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.llm.anchors import stretches
from ratecast.llm.bytes_hash import Substrings, blocks, mix
from ratecast.llm.common import partitions, stored

LENGTH, GRAM = 100, 32
LAST = 2 ** 63 - 1
#: Different strings of a bucket beyond which it is split by windows.
SPLIT = 16384
#: A suffix in the array: its bucket's number in the batch, then its bytes.
HEAD, WIDTH = 4, 2 * LENGTH - GRAM


def ordered(docs: DataFrame) -> DataFrame:
    """``doc_id, ord, key, text``: ord is the id with nulls last, key (a hash) tells texts of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"),
                       F.xxhash64(text).alias("key"), text.alias("text"))


def occurrences(docs: DataFrame) -> DataFrame:
    """``gram, whole, ord, key, start, size`` of every stretch.

    A stretch that equals an earlier one of its block has a negative size, and in place of the gram a number that
    deals it to any task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for b in batches:
            texts, at = [], []
            for o, t, s in zip(b.column("ord").to_pylist(), b.column("key").to_pylist(), b.column("text").to_pylist()):
                raw = s.encode()
                if len(raw) < LENGTH:
                    continue
                key = hashlib.blake2b(raw, digest_size=16).digest()
                if key in seen and seen[key] <= (o, t):
                    continue  # a whole copy of an earlier document
                if len(seen) > 500_000:
                    seen.clear()
                seen[key] = (o, t)
                texts.append(raw)
                at.append((o, t))
            ids = np.array(at, np.int64).reshape(-1, 2)
            for base, data, offsets in blocks(texts):
                text, start, end, _, gram = stretches(data, offsets, LENGTH, GRAM)
                who, whole, size = ids[base + text], Substrings(data, seed=1)(start, end), end - start
                place = start - offsets[text]
                order = np.lexsort((place, who[:, 1], who[:, 0], whole, gram))
                g, w, o, k, at = gram[order], whole[order], who[order, 0], who[order, 1], place[order]
                same_place = (o[1:] == o[:-1]) & (k[1:] == k[:-1]) & (at[1:] == at[:-1])
                later = order[1:][(g[1:] == g[:-1]) & (w[1:] == w[:-1]) & ~same_place]
                size[later] *= -1
                gram[later] = mix(gram[later] + place[later].astype(np.uint64) + who[later, 1].view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(np.ascontiguousarray(who[:, 0])),
                     pa.array(np.ascontiguousarray(who[:, 1])), pa.array(place.astype(np.int32)), pa.array(size.astype(np.int32))],
                    names=["gram", "whole", "ord", "key", "start", "size"])

    return docs.select("ord", "key", "text").mapInArrow(run, "gram long, whole long, ord long, key long, start int, size int")


#: kind 0: the stretch is a later copy of an equal one. 1: first of its kind in a bucket with other kinds.
#: 2: the same in a bucket with very many kinds.
FOUND = "kind int, gram long, whole long, ord long, key long, start int, size int"


def _repeated(rows: DataFrame) -> DataFrame:
    """From rows sorted by (gram, whole, ord, key, start): what repeats, as FOUND. Holds a bucket's first places only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, a: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32))] + [pa.array(np.ascontiguousarray(a[:, i])) for i in range(4)]
                                              + [pa.array(a[:, i].astype(np.int32)) for i in (4, 5)], names=["kind", "gram", "whole", "ord", "key", "start", "size"])

        last: np.ndarray | None = None  # the row before
        held: list[np.ndarray] = []  # first places of the open bucket
        n_held, split = 0, False
        for b in batches:
            a = np.column_stack([b.column(c).to_numpy().astype(np.int64) for c in ("gram", "whole", "ord", "key", "start", "size")])
            known = a[:, 5] < 0
            if known.any():
                yield out(0, a[known] * [1, 1, 1, 1, 1, -1])
                a = a[~known]
            before = np.vstack((a[:1] - 1 if last is None else last, a[:-1]))
            a = a[(a[:, :5] != before[:, :5]).any(1)]  # equal rows of the table are one place
            if not len(a):
                continue
            new_gram = np.concatenate(([last is None or a[0, 0] != last[0]], a[1:, 0] != a[:-1, 0]))
            new = new_gram | np.concatenate(([last is None or a[0, 1] != last[1]], a[1:, 1] != a[:-1, 1]))
            last = a[-1]
            if (~new).any():
                yield out(0, a[~new])
            firsts, opens = a[new], np.flatnonzero(new_gram[new])
            edges = np.concatenate((opens, [len(firsts)]))
            head = firsts[:edges[0]]  # goes on with the open bucket
            if len(head):
                held.append(head)
                n_held += len(head)
                if n_held > SPLIT:
                    yield out(2, np.concatenate(held))
                    held, split = [], True
            if len(opens):
                if held and n_held > 1 and not split:
                    yield out(1, np.concatenate(held))
                size = np.diff(edges)
                inner = np.repeat(size, size)
                inner[edges[-2] - edges[0]:] = 0  # the last bucket stays open
                body = firsts[edges[0]:]
                for kind, some in ((1, body[(inner > 1) & (inner <= SPLIT)]), (2, body[inner > SPLIT])):
                    if len(some):
                        yield out(kind, some)
                held, n_held, split = [firsts[edges[-2]:]], int(size[-1]), False
                if n_held > SPLIT:
                    yield out(2, held[0])
                    held, split = [], True
        if held and n_held > 1 and not split:
            yield out(1, np.concatenate(held))

    return rows.mapInArrow(run, FOUND)


def _per_document(found: DataFrame) -> DataFrame:
    return found.groupBy("ord", "key").agg(F.collect_list(F.struct("gram", "start", "size")).alias("wanted"))


def _strings(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``gram, ord, key, start, string``: the bytes of stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for o, k, s, wanted in zip(*(b.column(c).to_pylist() for c in ("ord", "key", "text", "wanted"))):
                raw = s.encode()
                rows += [(w["gram"], o, k, w["start"], raw[w["start"]:w["start"] + w["size"]]) for w in wanted]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                                 names=["gram", "ord", "key", "start", "string"])

    return (docs.join(_per_document(found), ["ord", "key"]).select("ord", "key", "text", "wanted")
            .mapInArrow(run, "gram long, ord long, key long, start int, string binary"))


#: Suffixes that are sorted at once, unless more of them begin alike.
PART = 1 << 15


def suffix_arrays(strings: list[bytes], bucket: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(string, offset, common prefix with the suffix before) of the sorted suffixes of at least LENGTH bytes.

    Suffixes of different buckets have no common prefix. The array comes in parts; suffixes of different parts
    differ in their bucket or first bytes.
    """
    size = np.array([len(s) for s in strings])
    n = size - LENGTH + 1
    which = np.repeat(np.arange(len(strings)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(strings) + b"\0" * WIDTH, np.uint8)
    head = np.zeros(len(which), np.uint64)
    for k in range(min(8, LENGTH)):
        head = head << np.uint64(8) | data[begin[which] + offset + k].astype(np.uint64)
    order = np.lexsort((head, bucket[which]))
    which, offset = which[order], offset[order]
    alike = np.flatnonzero(np.concatenate(([True], (head[order][1:] != head[order][:-1]) | (bucket[which][1:] != bucket[which][:-1]))))
    ends = np.append(alike[1:], len(which))
    lo = 0
    while lo < len(which):
        hi = int(ends[max(np.searchsorted(ends, lo + PART, "right") - 1, np.searchsorted(ends, lo, "right"))])
        yield _sorted_part(data, begin, size, bucket, which[lo:hi], offset[lo:hi])
        lo = hi


def _sorted_part(data: np.ndarray, begin: np.ndarray, size: np.ndarray, bucket: np.ndarray, which: np.ndarray,
                 offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = np.zeros((len(which), HEAD + WIDTH), np.uint8)
    table[:, :HEAD] = bucket[which].astype(">u4").view(np.uint8).reshape(-1, 4)
    length = size[which] - offset
    view = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[begin[which] + offset]
    table[:, HEAD:] = np.where(np.arange(WIDTH) < length[:, None], view, 0)
    order = np.argsort(table.view(f"S{HEAD + WIDTH}").ravel(), kind="stable")
    table, length = table[order], length[order]
    differ = table[1:] != table[:-1]
    common = np.where(differ.any(1), differ.argmax(1), HEAD + WIDTH) - HEAD
    common = np.minimum(np.maximum(common, 0), np.minimum(length[1:], length[:-1]))
    return which[order], offset[order], np.concatenate(([0], common))


def scan(common: np.ndarray, left: np.ndarray, least: int = LENGTH) -> list[tuple[int, int, int]]:
    """(first, last, length) of every left-diverse interval of common prefixes of at least ``least`` bytes.

    ``left``: the byte before each suffix; -1 is unlike any other.
    """
    found = []
    inside = common >= least
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    for lo, hi in zip(edge[::2] - 1, edge[1::2]):  # suffixes lo .. hi - 1 share a prefix
        if hi - lo == 2:
            if left[lo] < 0 or left[lo] != left[lo + 1]:
                found.append((int(lo), int(lo) + 1, int(common[lo + 1])))
            continue
        # on the stack: (length, first suffix, its left byte or -1 once diverse)
        c, byte = common[lo:hi].tolist(), left[lo:hi].tolist()
        stack: list[list] = []
        leaf = byte[0]
        for i in range(1, hi - lo + 1):
            now = c[i] if i < hi - lo else 0
            begin, mine = i - 1, leaf
            while stack and stack[-1][0] > now:
                length, begin, theirs = stack.pop()
                mine = mine if mine == theirs else -1
                if mine < 0:
                    found.append((int(lo) + begin, int(lo) + i - 1, length))
            if stack and stack[-1][0] == now:
                if stack[-1][2] != mine:
                    stack[-1][2] = -1
            elif now >= least:
                stack.append([now, begin, mine])
            if i < hi - lo:
                leaf = byte[i]
    return found


BATCH_STRINGS = 1024


def _covered(strings: DataFrame) -> DataFrame:
    """``ord, key, start, size``: what later occurrences in each bucket's maximal repeats cover."""

    def of_batch(rows: list[tuple]) -> pa.RecordBatch | None:
        grams, ords, keys, places, texts = zip(*rows)
        _, bucket = np.unique(np.array(grams), return_inverse=True)
        ords, keys, places = np.array(ords), np.array(keys), np.array(places)
        joined = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
        size = np.array([len(t) for t in texts])
        begin = np.cumsum(size) - size
        # all windows of a string hold its anchor, so what is covered of it is one run
        lo, hi = np.full(len(texts), WIDTH), np.zeros(len(texts), np.int64)
        for which, offset, common in suffix_arrays(list(texts), bucket):
            # the byte before a suffix, within its string
            left = np.where(offset > 0, joined[np.maximum(begin[which] + offset - 1, 0)], -1)
            o, k, p = ords[which], keys[which], places[which] + offset
            for a, b, length in scan(common, left):
                first = min(range(a, b + 1), key=lambda i: (o[i], k[i], p[i])) if b - a < 8 else a + int(np.lexsort((p[a:b + 1], k[a:b + 1], o[a:b + 1]))[0])
                rest = np.delete(np.arange(a, b + 1), first - a)
                np.minimum.at(lo, which[rest], offset[rest])
                np.maximum.at(hi, which[rest], offset[rest] + length)
        some = np.flatnonzero(hi)
        if not some.size:
            return None
        return pa.RecordBatch.from_arrays([pa.array(ords[some]), pa.array(keys[some]), pa.array((places[some] + lo[some]).astype(np.int32)),
                                           pa.array((hi - lo)[some].astype(np.int32))], names=["ord", "key", "start", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("gram", "ord", "key", "start", "string"))):
                if rows and row[:4] == rows[-1][:4]:
                    continue  # equal rows of the table are one place
                if len(rows) >= BATCH_STRINGS and row[0] != rows[-1][0]:
                    if (found := of_batch(rows)) is not None:
                        yield found
                    rows = []
                rows.append(row)
        if rows and (found := of_batch(rows)) is not None:
            yield found

    n = partitions(strings.sparkSession)
    return strings.repartition(n, "gram").sortWithinPartitions("gram", "ord", "key", "start").mapInArrow(run, "ord long, key long, start int, size int")


def _covered_split(strings: DataFrame) -> DataFrame:
    """The same for buckets with very many strings, window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("string").to_pylist()
            ords, keys, places = (b.column(c).to_numpy() for c in ("ord", "key", "start"))
            for base, data, offsets in blocks(texts, 1 << 18):
                n = np.diff(offsets) - LENGTH  # windows of each string
                which = np.repeat(np.arange(len(n)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                s = offsets[which] + at
                yield pa.RecordBatch.from_arrays(
                    [pa.array(Substrings(data)(s, s + LENGTH).view(np.int64)), pa.array(Substrings(data, seed=1)(s, s + LENGTH).view(np.int64)),
                     pa.array(ords[base + which]), pa.array(keys[base + which]), pa.array((places[base + which] + at).astype(np.int32))],
                    names=["w0", "w1", "ord", "key", "start"])

    w = strings.mapInArrow(run, "w0 long, w1 long, ord long, key long, start int")
    first = w.groupBy("w0", "w1").agg(F.min(F.struct("ord", "key", "start")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return (w.join(first, ["w0", "w1"]).where(F.struct("ord", "key", "start") != F.col("first"))
            .select("ord", "key", "start", F.lit(LENGTH).alias("size")))


def whole_copies(docs: DataFrame) -> DataFrame:
    """``ord, key, start, size`` of every document of LENGTH bytes or more whose text an earlier document has."""
    d = docs.select("ord", "key", F.xxhash64(F.lit("second"), "text").alias("other"), F.octet_length("text").alias("size")).where(F.col("size") >= LENGTH)
    first = d.groupBy("key", "other").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first != last").drop("last")
    return d.join(first, ["key", "other"]).where("ord != first").select("ord", "key", F.lit(0).alias("start"), "size")


def covered(docs: DataFrame) -> DataFrame:
    """``ord, key, start, size`` of stretches to remove, overlapping; ``docs`` as from ``ordered``."""
    n = partitions(docs.sparkSession)
    rows = occurrences(docs).repartition(n, "gram").sortWithinPartitions("gram", "whole", "ord", "key", "start")
    found = stored(_repeated(rows), "repeated_stretches")
    return (found.where("kind = 0").select("ord", "key", "start", "size")
            .unionByName(_covered(_strings(docs, found.where("kind = 1"))))
            .unionByName(_covered_split(_strings(docs, found.where("kind = 2"))))
            .unionByName(whole_copies(docs)))


def _cut(raw: bytes, spans: list) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes left, and the maximal removed runs."""
    merged: list[list[int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    kept, at = [], 0
    for s, e in merged:
        kept.append(raw[at:s])
        at = e
    return b"".join([*kept, raw[at:]]), [tuple(m) for m in merged]


DEDUPED = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def repeat_dedup(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` per document; with ``digest``, ``kept`` is the SHA-256 of the bytes."""
    docs = ordered(docs)
    end = (F.col("start") + F.col("size")).cast("long").alias("end")
    spans = covered(docs).groupBy("ord", "key").agg(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), end)).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        for b in batches:
            rows = []
            for i, s, gone in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                raw = s.encode()
                kept, runs = _cut(raw, [(g["start"], g["end"]) for g in gone or ()])
                rows.append((i, len(raw), len(raw) - len(kept), [{"start": x, "end": y} for x, y in runs],
                             hashlib.sha256(kept).digest() if digest else kept))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return docs.join(spans, ["ord", "key"], "left").select("doc_id", "text", "spans").mapInArrow(run, DEDUPED)
