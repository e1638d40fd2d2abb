import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecast.llm import codes

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


def brute(rows):
    """(code, error) per row in plain Python, the label sums and the digest."""
    ok = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted({(i is None, i or 0, tuple(v)) for i, v, _ in ok})
    first = [v for _, _, v in order if len(v) == len(order[0][2])][:256]
    n = len(first[0])
    ok = [r for r in ok if len(r[1]) == n]
    at = [(n * p // 4, n * (p + 1) // 4) for p in range(4)]
    books = [[list(v[lo:hi]) for v in first] for lo, hi in at]

    def assign(v, p):
        x = v[at[p][0]:at[p][1]]
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(4):
        got = [[[] for _ in b] for b in books]
        for _, v, _ in ok:
            for p in range(4):
                got[p][assign(v, p)[1]].append(v[at[p][0]:at[p][1]])
        books = [[[sum(c) // len(xs) for c in zip(*xs)] if xs else books[p][e] for e, xs in enumerate(got[p])] for p in range(4)]
    out, sums = [], {}
    for i, v, lab in ok:
        best = [assign(v, p) for p in range(4)]
        err = sum(d for d, _ in best)
        out.append((i, lab, "".join(f"{e:02x}" for _, e in best), err))
        sums[lab] = sums.get(lab, 0) + err
    text = ",".join(str(x) for b in books for c in b for x in c)
    return sorted(((i, c, e, sums[lab]) for i, lab, c, e in out), key=str), hashlib.sha256(text.encode()).hexdigest()


def run(df):
    coded, books = codes.compress(df)
    rows = codes.with_label_errors(coded).select("vec_id", "code", "error", "label_error").collect()
    return sorted((tuple(r) for r in rows), key=str), codes.books_sha256(books)


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame(rows, VECTORS).withColumns({"code": F.lit("x"), "v": F.lit(1)}).repartition(3)


def test_against_brute_force(vectors):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.02, 12)], int(i) % 3) for i in rng.permutation(400)]
    assert run(vectors(rows)) == brute(rows)


def test_many_equal_vectors_and_ties(vectors):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 8) / 1024], i % 2) for i in range(300)] + [(i, [0.0] * 8, None) for i in range(300, 500)]
    assert run(vectors(rows)) == brute(rows)


def test_edge_cases(vectors):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.5, 0.25, -0.1, 0.0, 1.0], 1), (None, [0.5, 0.25, -0.1, 0.0, 2.0], None), (4, None, 1), (5, [0.1, None, 0.2, 0.3, 0.1], 2),
            (6, [nan, 0.0, 0.0, 0.0, 0.0], 2), (7, [0.0, inf, 0.0, 0.0, 0.0], 2), (8, [1.0], 2), (9, [], 2),
            (3, [0.5, 0.25, -0.1, 0.0, 1.0], 1), (3, [0.5, 0.25, -0.2, 0.0, 1.0], None)]
    got = run(vectors(rows))
    assert got == brute(rows)
    assert len(got[0]) == 4 and {r[0] for r in got[0]} == {3, None}


def test_empty_table_and_empty_vectors(vectors):
    assert run(vectors([]))[0] == []
    assert run(vectors([(1, None, 1)]))[0] == []
    assert run(vectors([(1, [], 1), (2, [], 2)]))[0] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]


def test_trie_walk_equals_full_distances():
    rng = np.random.default_rng(7)
    for width, spread in ((1, 3), (5, 2), (16, 50)):
        parts = rng.integers(-spread, spread, (2000, width)).astype(np.int32)
        entries = rng.integers(-spread, spread, (40, width))
        leaves, which, weight = codes.distinct_parts(parts)
        assert (leaves[which] == parts).all() and weight.sum() == 2000
        full = ((leaves[:, None, :] - entries[None]) ** 2).sum(2)
        code, distance = codes.nearest(leaves, entries)
        assert (code == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_too_large_component_is_an_error(vectors):
    with pytest.raises(Exception, match="component beyond"):
        run(vectors([(1, [40000.0] * 4, 1)]))
