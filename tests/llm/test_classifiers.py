import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.llm import labelled, quality, queries, toxicity

SF = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(label) - n1))


@pytest.mark.parametrize("name,label,least", [("op6_toxicity", "toxic", 0.95), ("op7_quality", "quality", 0.98)])
def test_held_out_accuracy(spark, name, label, least):
    got = queries.queries()[name](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    df = got.join(labels, "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in df.doc_id)
    assert auc(df.score.to_numpy(), df[label].to_numpy()) >= least
    assert ((df.predicted == df[label]).mean()) >= 0.95
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


@pytest.mark.parametrize("model,label", [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_held_out_labels_and_other_columns_do_not_matter(spark, docs, model, label):
    rows = [(i, ("good plain text here " if i % 3 else "### $$$ idiot ### ") * (1 + i % 4)) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], f"doc_id long, {label} int")
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 0
    flipped = labels.withColumn(label, F.when(held, 1 - F.col(label)).otherwise(F.col(label)))
    a, b = ({r.doc_id: r.score for r in model(docs(rows, clashing=c), l).collect()} for c, l in ((False, labels), (True, flipped)))
    assert a == b and min(a[i] for i in range(300) if i % 3) > max(a[i] for i in range(300) if i % 3 == 0)


@pytest.mark.parametrize("model,label", [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_edge_cases(spark, docs, model, label):
    empty = spark.createDataFrame([], f"doc_id long, {label} int")
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "y " * 300000), (4, "\0\x01")]
    got = model(docs(rows), empty).collect()
    assert len(got) == 6 and {r.score for r in got} == {0.5}
    odd = spark.createDataFrame([(None, 1), (3, None), (1, 5), (2, 1), (2, 0)] + [(k, k % 2) for k in range(10, 80)], f"doc_id long, {label} int")
    many = rows + [(k, "bad $$$ idiot" if k % 2 else "fine words") for k in range(10, 80)]
    assert all(0 <= r.score <= 1 for r in model(docs(many), odd).collect())
    assert model(docs([]), odd).count() == 0


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(1)
    x = [np.unique(rng.integers(0, 50, 10)) + (100 if k % 2 else 200) for k in range(80)]
    y = np.arange(80) % 2
    w, b = quality.dual_coordinate_descent(x, [np.full(len(t), 0.3) for t in x], y, np.full(80, 10.0), epochs=200)
    assert all((w[t].sum() * 0.3 + b > 0) == (label == 1) for t, label in zip(x, y))


def test_factorization_machine_learns_a_pair():
    """The label is whether both of two terms are there: no linear weights give that from single terms alone."""
    rng = np.random.default_rng(2)
    found, y = [], []
    for _ in range(2000):
        a, b = (rng.random(2) < 0.5).tolist()
        found.append(np.sort(np.array([10] * a + [20] * b + [int(x) for x in set(rng.integers(30, 40, 2))], np.int64)))
        y.append(int(a and b))
    m = toxicity.fit(found, np.array(y, np.int8), epochs=30)
    weights = dict(zip(m.terms.tolist(), range(len(m.terms))))
    assert m.factor[weights[10]] @ m.factor[weights[20]] > 0.2
    assert auc(m.scores(found), np.array(y)) > 0.98


def test_a_task_holds_the_features_of_few_texts(spark):
    def score(found):
        assert len(found) <= 256, len(found)
        return np.array([float(f.size) for f in found])

    df = spark.range(3000).coalesce(1).selectExpr("id as doc_id", "repeat('word ', int(id % 7)) as text")
    got = labelled.scored(df, quality.features, score, 0.5).collect()
    want = {t: f.size for t, f in zip([k * "word " for k in range(7)], labelled.text_features([k * "word " for k in range(7)], quality.features))}
    assert len(got) == 3000 and all(r.score == want[r.text] for r in got)
