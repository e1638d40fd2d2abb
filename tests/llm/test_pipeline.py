"""Each stage of the pipeline against a brute-force version of it, on its predecessor's output."""

import importlib

import corpus_pipeline as P
from ratecast.llm import queries
from ratecast.llm.common import documents, stored
from tests.llm import test_jaccard_join, test_line_dedup

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_brute_force(spark):
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    before, all_rows = raw, rows(raw)
    out = {}
    for name, stage in P.STAGES:
        before = stored(stage(spark, before, SF), f"test_{name}")
        if name != "best_fit_packing":
            assert before.columns == raw.columns
            out[name] = rows(before)
    accepted = {r.doc_id for r in queries.op7_quality(spark, SF).where("predicted = 1").collect()}
    assert out["quality_classifier"] == {i: t for i, t in all_rows.items() if i in accepted}
    lines = test_line_dedup.brute(list(out["quality_classifier"].items()))
    assert out["line_dedup"] == {i: t for i, (t, gone) in lines.items() if not gone or t.strip(" ")}
    groups = test_jaccard_join.brute(list(out["line_dedup"].items()))
    assert out["jaccard_join"] == {i: out["line_dedup"][i] for i, _, least in groups if i == least}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {i for i, t in out["jaccard_join"].items() if not any(x in t for x in items)}
    assert out["benchmark_decontamination"].keys() <= kept
    assert {r.doc_id for r in before.collect()} == out["benchmark_decontamination"].keys()
    end = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        end = stage(spark, end, SF)
    assert end.count() == 0


def test_null_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, None, None, None, None), (1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (2, "", None, "s", 0)],
                               spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in P.STAGES:
        df = stored(stage(spark, df.selectExpr("*"), SF), "odd")
    assert df.columns[:2] == ["doc_id", "piece"]


def test_decisions_hold_for_the_row_not_the_id(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = " ".join(f"word{k}" for k in range(300))
    near_text, other = text + " end", " ".join(f"other{k}" for k in range(300))

    def made(pairs):
        return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in pairs], schema)

    cases = [([(None, text), (None, near_text), (None, other)], 2), ([(7, text), (7, near_text), (7, other)], 2),
             ([(7, text), (7, text), (8, other)], 2), ([(None, text), (3, near_text), (2, text + " 2")], 1)]
    for pairs, n in cases:
        left = sorted((r.doc_id or 0, r.text) for r in P.dedup_near(spark, made(pairs), SF).collect())
        assert len(left) == n and sum(t != other for _, t in left) == 1
    assert left == [(2, text + " 2")]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    pairs = [(None, item), (None, other), (5, f"{text} {item}"), (5, text)]
    assert {(r.doc_id, r.text) for r in P.decontaminate_benchmark(spark, made(pairs), SF).collect()} == {(None, other), (5, text)}


def test_registered_queries():
    names = importlib.import_module("__spark_entry__").queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert documents is not None
