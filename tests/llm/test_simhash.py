import hashlib

import numpy as np

from pyspark.sql import functions as F

from ratecast.llm import queries, simhash
from tests.llm.conftest import words


def expected(rows):
    """n_chars and the hash of the edited text of each row, next by descending id (null last)."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, t) in enumerate(rows):
        h, after = len(t) // 2, rows[(k + 1) % len(rows)][1]
        out[i] = (len(t), hashlib.sha256((t[:len(t) - h] + after[:h]).encode()).hexdigest())
    return out


def test_edited_texts_over_many_ranges(docs):
    rng = np.random.default_rng(1)
    rows = [(int(i) * 3 + int(i > 200) * 10 ** 9, words(rng, int(rng.integers(0, 40)))) for i in range(400)]
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in simhash.simhash(docs(rows)).collect()}
    assert got == expected(rows)


def test_ranges_are_even_with_clustered_and_null_ids(docs):
    from ratecast.llm.common import keyed

    rows = [(int(i), f"text {i}") for i in range(4000)] + [(10 ** 18, "far"), (-10 ** 18, "low")] + [(None, f"null {k}") for k in range(2000)]
    ranged = simhash.with_ranges(keyed(docs(rows))).where("not guest")
    assert ranged.count() == len(rows) and ranged.groupBy("rng").count().agg(F.max("count")).first()[0] <= 300
    few = rows[:3] + rows[4000:4002] + rows[3990:4000]
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in simhash.simhash(docs(few * 1 + [(k + 5000, f"more {k}") for k in range(300)])).collect()}
    assert got == expected(few + [(k + 5000, f"more {k}") for k in range(300)])


def test_fingerprints(docs):
    rng = np.random.default_rng(2)
    a = words(rng, 300)
    rows = [(1, a), (2, words(rng, 300)), (3, a), (4, None), (5, ""), (None, "null id ü"), (6, "x " * 20000)]
    got = {r.doc_id: r for r in simhash.simhash(docs(rows, clashing=True)).collect()}
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == expected(rows)
    assert got[1].own == got[3].own and got[4].own == got[5].own
    like = lambda x, y: 1 - (bin((x.f0 ^ y.f0) & (2 ** 64 - 1)).count("1") + bin((x.f1 ^ y.f1) & (2 ** 64 - 1)).count("1")) / 128
    assert like(got[1].own, got[1].edited) > 0.55 > like(got[1].own, got[2].own) > 0.3
    assert got[3].next == got[2].own and got[None].next == got[6].own


def test_repeated_rows_are_one_document(docs):
    """The next document of both twins is the third one, not the twin."""
    s, t = "one two three four", "five six seven eight"
    rows = simhash.fingerprints(docs([(50, s), (50, s), (50, s), (40, t), (None, t), (None, t)])).collect()
    want = expected([(50, s), (40, t), (None, t)])
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == want and len(rows) == 3
    assert next(r.n_near for r in rows if r.doc_id == 50) == 1


def test_votes_against_python(docs):
    df = docs([(1, "a b a b c"), (2, "z")]).select("doc_id", F.explode(simhash.terms(F.col("text"))).alias("t"))
    terms = {}
    for r in df.withColumn("u", F.xxhash64(F.lit("second"), "t")).collect():
        terms.setdefault(r.doc_id, []).append((r.t % 2 ** 64, r.u % 2 ** 64))
    prints = {r.doc_id: r.own for r in simhash.simhash(docs([(1, "a b a b c"), (2, "z")])).collect()}
    for i, hs in terms.items():
        for half, got in ((0, prints[i].f0), (1, prints[i].f1)):
            want = sum(1 << k for k in range(64) if 2 * sum(h[half] >> k & 1 for h in hs) > len(hs))
            assert got % 2 ** 64 == want


def test_near_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(3)
    prints = []
    for _ in range(40):
        base = [int(x) for x in rng.integers(-2 ** 63, 2 ** 63, 2)]
        for _ in range(4):
            f = list(base)
            for b in rng.choice(128, int(rng.integers(0, 6)), replace=False):
                f[b // 64] ^= 1 << int(b % 64)
            prints.append(tuple((x + 2 ** 63) % 2 ** 64 - 2 ** 63 for x in f))
    df = spark.createDataFrame([(p,) for p in prints], "own struct<f0:long,f1:long>")
    bits = lambda x, y: sum(bin((a ^ b) & (2 ** 64 - 1)).count("1") for a, b in zip(x, y))
    for radius in (0, 3):
        got = {(tuple(r.q), tuple(r.e), r.bits) for r in simhash.near(df, df, radius).collect()}
        assert got == {(x, y, bits(x, y)) for x in prints for y in prints if bits(x, y) <= radius}


def test_near_is_exact_at_the_radius_of_edited_copies(spark):
    radius = simhash.radius_for(0.75)
    assert 18 <= radius <= 22 and simhash.radius_for(1.0) == 0
    rng = np.random.default_rng(4)
    prints = []
    for _ in range(30):
        base = [int(x) for x in rng.integers(-2 ** 63, 2 ** 63, 2)]
        for _ in range(6):
            f = list(base)
            for b in rng.choice(128, int(rng.integers(0, 15)), replace=False):
                f[b // 64] ^= 1 << int(b % 64)
            prints.append(tuple((x + 2 ** 63) % 2 ** 64 - 2 ** 63 for x in f))
    df = spark.createDataFrame([(p,) for p in prints], "own struct<f0:long,f1:long>")
    bits = lambda x, y: sum(bin((a ^ b) & (2 ** 64 - 1)).count("1") for a, b in zip(x, y))
    got = [(tuple(r.q), tuple(r.e), r.bits) for r in simhash.near(df, df, radius).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(x, y, bits(x, y)) for x in prints for y in prints if bits(x, y) <= radius}


def test_edited_copies_of_real_texts_are_found(spark, docs):
    rng = np.random.default_rng(5)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    texts = [t for t in texts if t and 200 <= len(t.split()) <= 1500][:60]
    rows = []
    for k, t in enumerate(texts):
        w = t.split()
        for p in rng.choice(len(w), int(len(w) * (0.01 + 0.015 * (k % 2))), replace=False):
            w[p] = f"edit{p}"
        rows += [(50 * (k + 1), t), (50 * (k + 1) + 1, " ".join(w))]
    got = {r.doc_id: r for r in simhash.fingerprints(docs(rows)).collect()}
    name = lambda f: f"{f.f0 % 2 ** 64:016x}{f.f1 % 2 ** 64:016x}"
    found = sum(name(got[50 * (k + 1) + 1].own) in got[50 * (k + 1)].near for k in range(len(texts)))
    assert len(texts) == 60 and found >= 57
    assert all(name(got[50 * (k + 1)].own) in got[50 * (k + 1)].near and got[50 * (k + 1) + 1].near is None for k in range(60))
    ours = {r.doc_id: r.own for r in got.values()}
    for r in got.values():
        if r.near is not None:
            assert r.n_near == sum(name(f) in r.near for f in ours.values()) and r.near == sorted(set(r.near))


def test_small_tables(docs):
    assert simhash.fingerprints(docs([])).count() == 0
    one = simhash.simhash(docs([(4, "only row")])).first()
    assert one.next == one.own and one.edited_sha256 == expected([(4, "only row")])[4][1]
    twice = simhash.fingerprints(docs([(50, "same text"), (50, "same text")])).collect()
    assert [r.n_near for r in twice] == [1]  # equal rows are one document
    assert [r.n_near for r in simhash.fingerprints(docs([(50, "same text"), (51, "same text")])).orderBy("doc_id").collect()] == [2, None]


def test_query_has_no_python(spark):
    plan = queries.op4_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
