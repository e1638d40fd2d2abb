"""Best-fit packing of tokenised documents into fixed-length sequences, by exact complements.

A document is its token ids and an end id. Only documents longer than a
sequence are cut: into full pieces, the remainder first. How pieces go together
depends on their lengths alone, so the plan is made on the counts of the (at
most ``capacity``) lengths: from the longest piece down, the gap it leaves is
looked up among the lengths, the sums of two and the sums of three that are
still available; where none fills it exactly, the best-fitting length goes in
and the rest of the gap is looked up again. One step takes as many equal
sequences as the counts allow, so the plan has a few thousand lines however
many documents there are, and every line says which ranks of a length go to
which sequences at which offset. Pieces then get their rank within their
length and read their place off the plan.

Defined cases: a null or empty text is the end id alone; the name of a special
token in a text is that token, as the tokenizer has it by default; equal rows are
packed each for itself; an empty table gives no row.
"""

from __future__ import annotations

import base64
import importlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratecast.llm.common import released, stored, tokenizer_path

CAPACITY, END_ID = 1024, 2
#: Fixed value: the vocabulary's one special token.
SPECIAL = "<|endoftext|>"
#: Bytes of words and ids that a task remembers, with what an entry costs besides; longer words are not remembered.
CACHE_BYTES, ENTRY_BYTES, LONGEST_WORD = 48 << 20, 200, 64
#: White space whose splitting depends on what is around it: all but single spaces and line ends.
UNEVEN = re.compile(r"[^\S \n]|[ \n]{2}")

_loaded: dict = {}


def _ranks(name: str):
    """The vocabulary as ranks: the encoder that is used but for special tokens."""
    import tiktoken

    with open(tokenizer_path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = importlib.import_module("public_tokenizers").PATTERN
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _tokenizer(name: str):
    """The tokenizer itself: loaded only where a text names a special token."""
    from tokenizers import Tokenizer

    return _kept(f"{name}.json", lambda: Tokenizer.from_file(tokenizer_path(f"{name}.json")))


def _kept(key: str, make):
    """What ``make`` gives, made once in a Python worker."""
    if key not in _loaded:
        _loaded[key] = make()
    return _loaded[key]


class _Words:
    """Ids of words seen: at the beginning of a line, and after a space. Forgets all when it holds CACHE_BYTES."""

    def __init__(self, ranked):
        self.ranked, self.end = ranked, np.array(ranked("\n"), "<u4").tobytes()
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.size = 0

    def _of(self, seen: dict[str, bytes], word: str, text: str) -> bytes:
        ids = seen.get(word)
        if ids is None:
            ids = np.array(self.ranked(text), "<u4").tobytes() if text else b""
            if len(word) <= LONGEST_WORD:
                self.size += len(word) + len(ids) + ENTRY_BYTES
                if self.size > CACHE_BYTES:
                    self.first.clear()
                    self.later.clear()
                    self.size = 0
                seen[word] = ids
        return ids

    def line(self, line: str) -> bytes:
        head, *words = line.split(" ")
        later = self.later
        return self._of(self.first, head, head) + b"".join([later.get(w) or self._of(later, w, " " + w) for w in words])


def encode(texts: list[str], name: str) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit numbers.

    Byte-level BPE first splits a text, and it splits at every single space (which
    goes with the word after it) and around every single line end. So a word's
    ids are found once, by the ranks of the vocabulary, and then remembered, up
    to a number of bytes. Texts with other white space are encoded whole, texts
    naming the special token by the tokenizer itself.
    """
    ranked = _kept(f"{name}.tiktoken", lambda: _ranks(name))
    words = _kept(f"{name} words", lambda: _Words(ranked))
    out = []
    for t in texts:
        if SPECIAL in t:
            out.append(np.array(_tokenizer(name).encode(t, add_special_tokens=False).ids, "<u4").tobytes())
        elif UNEVEN.search(t):
            out.append(np.array(ranked(t), "<u4").tobytes())
        else:
            out.append(words.end.join(map(words.line, t.split("\n"))))
    return out


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: the remainder first, then full pieces."""
    first = n % capacity or capacity
    return [(0, min(first, n))] + [(s, capacity) for s in range(first, n, capacity)]


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document, with their checksums."""
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int32()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = part.column(0).to_pylist()
                rows = []
                for doc, data in zip(ids, encode([t or "" for t in part.column(1).to_pylist()], vocabulary)):
                    data += end
                    for k, (s, n) in enumerate(cut(len(data) // 4, capacity)):
                        rows.append((doc, k, s, n, zlib.crc32(data[4 * s:4 * (s + n)])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(run), PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths, how many sequences hold exactly these) from the counts of the lengths."""
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    out = []

    def complement(gap: int) -> list[int]:
        """One, two or three available lengths that sum to the gap, the largest first; else nothing."""
        if left[gap]:
            return [gap]
        have = np.flatnonzero(left[:gap])
        pairs = [int(a) for a in have if left[gap - a] > (2 * a == gap)]
        if pairs:
            return [max(pairs), gap - max(pairs)]
        for a in have[::-1]:
            left[a] -= 1
            rest = gap - int(a)
            two = [int(b) for b in np.flatnonzero(left[:rest]) if left[rest - b] > (2 * b == rest)] if rest > 0 else []
            left[a] += 1
            if two:
                return [int(a), max(two), rest - max(two)]
        return []

    for n in range(capacity, 0, -1):
        while left[n]:
            left[n] -= 1
            one, gap = [n], capacity - n
            while gap:
                more = complement(gap)
                if not more:
                    fits = np.flatnonzero(left[:gap + 1])
                    if not fits.size:
                        break
                    more = [int(fits[-1])]
                for m in more:
                    left[m] -= 1
                one += more
                gap -= sum(more)
            uses = {m: one.count(m) for m in one}
            for m, k in uses.items():  # give the first back, then take as many as there are
                left[m] += k
            times = min(int(left[m]) // k for m, k in uses.items())
            for m, k in uses.items():
                left[m] -= k * times
            out.append((one, times))
    return out


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, rows_per_group: int = 50_000) -> DataFrame:
    """Every piece with its sequence and its offset in it."""
    spark = docs.sparkSession
    p = stored(pieces(docs, vocabulary, capacity, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row per length
    lengths, first_rank, first_seq, offsets = _places(plan(counts, capacity))
    # rank within a length: rank within (group, length), and what the groups before it hold
    groups = max(1, sum(counts.values()) // rows_per_group)
    p = p.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    sizes = p.groupBy("grp", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("grp", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("grp", "length").orderBy("doc_id", "piece")) - 1
    ranked = p.withColumn("inside", inside).join(sizes, ["grp", "length"]).withColumn("rank", F.col("inside") + F.col("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = int(first_rank.max(initial=0)) + 1
        keys = lengths.astype(np.float64) * span + first_rank  # sorted: lengths ascend, ranks within them
        exact = span * (capacity + 1) < 2 ** 53
        for b in batches:
            n, r = b.column("length").to_numpy(), b.column("rank").to_numpy()
            if exact:
                at = np.searchsorted(keys, n.astype(np.float64) * span + np.minimum(r, span - 1), "right") - 1
            else:
                at = np.empty(len(n), np.int64)
                for m in np.unique(n):
                    lo, hi = np.searchsorted(lengths, [m, m + 1])
                    at[n == m] = lo + np.searchsorted(first_rank[lo:hi], r[n == m], "right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "piece", "start")]
                + [pa.array(n.astype(np.int64)), b.column("ids_crc32"),
                   pa.array(first_seq[at] + r - first_rank[at]), pa.array(offsets[at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    if not counts:
        return spark.createDataFrame([], PLACED)
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(released(place), PLACED)


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _places(lines: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The plan by length and rank: from this rank of this length on, this sequence and this offset."""
    taken: dict[int, int] = {}
    rows, seq = [], 0
    for one, times in lines:
        offset = 0
        for n in one:
            rows.append((n, taken.get(n, 0), seq, offset))
            taken[n] = taken.get(n, 0) + times
            offset += n
        seq += times
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return a[:, 0], a[:, 1], a[:, 2], a[:, 3]
