"""Vector compression: product codes by exact integer k-means over tries of distinct parts.

A vector becomes integers (``floor(SCALE * x)``) and is cut into PARTS
consecutive parts; each part position has a codebook of at most ENTRIES
entries, refined by ROUNDS rounds of assignment and mean. Within a task the
distinct parts of a batch of vectors, sorted, are the leaves of a trie over
dimensions: parts with a common beginning share its nodes. A node holds the
squared distances to all entries summed over the dimensions so far; they are
computed once a node, walking down in the parts' sorted order, block after block, with the
last path kept on a stack. A leaf takes the nearest entry (ties: the lower
index) and adds its part, weighted by how many vectors have it, to the entry's
sum. A task sends one partial sum an entry, so what is shuffled and what reaches the
driver is bounded by the codebooks, whatever the number of vectors; copies of
one vector are one leaf.

All arithmetic is in 64-bit integers, so results do not depend on
partitioning.

Defined cases: a null vector, or one with null, NaN or infinite components, is
dropped; so is one whose length is not that of the first kept vector. First means
least id (null ids last), then least vector; the codebooks start from the first
distinct (id, vector) pairs, fewer than ENTRIES if there are fewer. Repeated rows
are each returned and each counted in the means. A length that PARTS does not divide is cut at
``floor(i * length / PARTS)``. A component of 2**15 or more in absolute value is an
error, as sums of squares would not fit. Labels may be null; null labels are one label. An empty table
gives no row. Columns not named are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.llm.common import sized, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = 2 ** 15
#: Leaves of a trie whose distances are held at once.
BLOCK = 256

CODED = "vec_id long, label int, code string, error long"


def quantised(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, label, v``: the kept vectors as integers."""
    x = F.col(vector)
    kept = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    as_int = F.transform(x, lambda c: F.when(F.abs(c) < LARGEST, F.floor(c.cast("double") * SCALE))
                         .otherwise(F.raise_error(F.lit(f"vector component beyond {LARGEST}")).cast("long")).cast("int"))
    return (vectors.where(kept)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), as_int.alias("v")))


def first_vectors(kept: DataFrame, n: int) -> list[list[int]]:
    """The n first distinct (id, vector) pairs' vectors; a task sends n rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[tuple] = []
        for b in batches:
            ids = b.column(0).to_pylist()
            bound = least[-1][:2] if len(least) == n else None
            at = [i for i, x in enumerate(ids) if bound is None or (x is None, x or 0) <= bound]
            found = {(ids[i] is None, ids[i] or 0, tuple(b.column(1)[i].as_py())) for i in at}
            least = heapq.nsmallest(n, found.union(least))
        yield pa.RecordBatch.from_arrays([pa.array([None if x[0] else x[1] for x in least], pa.int64()),
                                          pa.array([list(x[2]) for x in least], pa.list_(pa.int32()))], names=["vec_id", "v"])

    rows = kept.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<int>").distinct()
    return [r.v for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(n).collect()]


def cuts(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    edges = [length * i // parts for i in range(parts + 1)]
    return list(zip(edges[:-1], edges[1:]))


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, which of them each row is, and how many rows each has."""
    n, width = parts.shape
    order = np.lexsort(parts.T[::-1]) if width else np.arange(n)
    rows = parts[order]
    new = np.concatenate(([True], (rows[1:] != rows[:-1]).any(1))) if n else np.zeros(0, bool)
    which = np.empty(n, np.int64)
    which[order] = np.cumsum(new) - 1
    return rows[new], which, np.bincount(which, minlength=int(new.sum()))


def nearest(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of sorted distinct parts, by a walk down their trie.

    ``first[r]`` is the first dimension in which leaf r leaves the path of the leaf
    before; at every dimension from there on it opens a node of its own.
    """
    n, width = leaves.shape
    code, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not width:
        return code, distance
    first = np.zeros(n, np.int64)
    first[1:] = (leaves[1:] != leaves[:-1]).argmax(1)
    # stack[j]: the distances of the last leaf's path over its dimensions before j
    stack = np.zeros((width + 1, len(entries)), np.int64)
    for lo in range(0, n, BLOCK):
        block, opens = leaves[lo:lo + BLOCK], first[lo:lo + BLOCK]
        if lo == 0:
            opens = np.where(np.arange(len(block)) == 0, 0, opens)
        above, node = stack[:1], np.zeros(len(block), np.int64)  # nodes a level up, and which is each leaf's
        for j in range(width):
            new = opens <= j
            kept_path = not new[0]  # the block's first leaf is still on the last block's path here
            distances = above[node[new]] + (block[new, j].astype(np.int64)[:, None] - entries[None, :, j]) ** 2
            above = np.concatenate((stack[j + 1:j + 2], distances)) if kept_path else distances
            node = np.cumsum(new) - (0 if kept_path else 1)
            stack[j + 1] = above[-1]
        # the last dimension opens a node for every leaf, as leaves differ
        code[lo:lo + BLOCK] = above[node].argmin(1)
        distance[lo:lo + BLOCK] = above[node].min(1)
    return code, distance


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, length)


def _refined(vectors: DataFrame, books: list[np.ndarray], at: list[tuple[int, int]]) -> list[np.ndarray]:
    """The codebooks after one round."""
    length = at[-1][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(c), np.int64) for c in books]
        sums = [np.zeros(c.shape, np.int64) for c in books]
        for b in batches:
            v = _matrix(b, length)
            for p, (lo, hi) in enumerate(at):
                leaves, _, weight = distinct_parts(v[:, lo:hi])
                code, _ = nearest(leaves, books[p])
                np.add.at(counts[p], code, weight)
                np.add.at(sums[p], code, leaves.astype(np.int64) * weight[:, None])
        for p, (count, total) in enumerate(zip(counts, sums)):
            used = np.flatnonzero(count)
            width = total.shape[1] + 1
            value = np.column_stack((count, total))[used].ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), p, np.int32)), pa.array(np.repeat(used, width).astype(np.int32)),
                                              pa.array(np.tile(np.arange(width), len(used)).astype(np.int32)), pa.array(value)],
                                             names=["part", "entry", "at", "value"])

    # at 0: the number of parts, at i + 1: the sum of their component i
    rows = vectors.select("v").mapInArrow(run, "part int, entry int, at int, value long").groupBy("part", "entry", "at").agg(F.sum("value").alias("value"))
    total = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in books]
    for r in rows.collect():  # ENTRIES x (length + PARTS) rows at most
        total[r.part][r.entry, r.at] = r.value
    return [np.where(t[:, :1] > 0, t[:, 1:] // np.maximum(t[:, :1], 1), c) for t, c in zip(total, books)]


def _coded(vectors: DataFrame, books: list[np.ndarray], at: list[tuple[int, int]]) -> DataFrame:
    length = at[-1][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, codes, error = _matrix(b, length), [], np.zeros(b.num_rows, np.int64)
            for p, (lo, hi) in enumerate(at):
                leaves, which, _ = distinct_parts(v[:, lo:hi])
                code, distance = nearest(leaves, books[p])
                codes.append(code[which])
                error += distance[which]
            text = [bytes(c).hex() for c in np.column_stack(codes).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(text, pa.string()), pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "v").mapInArrow(run, CODED)


def compress(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every kept vector, and the codebooks (one array of entries a part)."""
    kept = quantised(vectors, vector)
    first = first_vectors(kept, ENTRIES)
    if not first:
        return vectors.sparkSession.createDataFrame([], CODED), []
    length = len(first[0])
    at = cuts(length)
    if any(len(v) != length for v in first):
        first = first_vectors(kept.where(F.size("v") == length), ENTRIES)
    start = np.array(first, np.int64).reshape(len(first), length)
    kept = stored(kept.where(F.size("v") == length), "quantised_vectors")
    books = [start[:, lo:hi] for lo, hi in at]
    for _ in range(rounds):
        books = _refined(kept, books, at)
    return stored(_coded(kept, books, at), "vector_codes"), books


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for c in books for x in c.ravel()).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over the rows of the same label (null: one label)."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(sized(sums), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def sql(length_of: str = "embedding") -> str:
    """The same codes in DuckDB: every round is a few CTEs."""
    part = ", ".join(f"{{'p': {p}, 'x': v[len(v) * {p} // {PARTS} + 1:len(v) * {p + 1} // {PARTS}]}}" for p in range(PARTS))
    ctes = [f"""k AS MATERIALIZED (SELECT vec_id, label, list_transform({length_of}, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v FROM embeddings
             WHERE {length_of} IS NOT NULL AND len(list_filter({length_of}, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
            f"parts AS MATERIALIZED (SELECT vec_id, label, s.p AS p, s.x AS x FROM (SELECT vec_id, label, unnest([{part}]) AS s FROM k))",
            f"first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < {ENTRIES})",
            "b0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN first USING (vec_id))"]
    near = """(SELECT vec_id, label, p, x, min({{'d': d, 'e': e}}) AS m FROM (SELECT vec_id, label, parts.p AS p, x, e,
               list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
               FROM parts JOIN b{r} ON b{r}.p = parts.p) GROUP BY vec_id, label, p, x)"""
    for r in range(ROUNDS):
        ctes += [f"a{r} AS MATERIALIZED {near.format(r=r)}",
                 f"u{r} AS (SELECT p, m.e AS e, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM a{r})",
                 f"""s{r} AS (SELECT p, e, list(f ORDER BY i) AS c FROM (SELECT p, e, i, ((sum(x)::BIGINT
                     - ((sum(x)::BIGINT % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS f FROM u{r} GROUP BY p, e, i) GROUP BY p, e)""",
                 f"b{r + 1} AS MATERIALIZED (SELECT b.p AS p, b.e AS e, coalesce(s.c, b.c) AS c FROM b{r} b LEFT JOIN s{r} s ON s.p = b.p AND s.e = b.e)"]
    ctes += [f"z AS MATERIALIZED {near.format(r=ROUNDS)}",
             "o AS (SELECT vec_id, label, string_agg(lower(printf('%02x', m.e)), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM z GROUP BY vec_id, label)",
             f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s FROM b{ROUNDS})"]
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT s FROM h) AS codebooks_sha256 FROM o"""
