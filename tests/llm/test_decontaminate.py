import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.llm import decontaminate as D
from tests.llm.conftest import words

ITEMS = "item_id long, text string"


def bm25(items, passage):
    """Share of each item's BM25 weight that the passage's words cover, straight from the formula."""
    lists = [re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower()) for t in items]
    mean = sum(map(len, lists)) / len(lists)
    found = set(re.findall(r"[a-z0-9\x80-\U0010ffff]+", passage.lower()))
    out = []
    for words_ in lists:
        w = {}
        for t in set(words_):
            df = sum(t in x for x in lists)
            tf = words_.count(t)
            w[t] = np.log(1 + (len(lists) - df + 0.5) / (df + 0.5)) * tf * (D.K1 + 1) / (tf + D.K1 * (1 - D.B + D.B * len(words_) / mean))
        out.append(sum(v for t, v in w.items() if t in found) / sum(w.values()))
    return out


def corpus(rng):
    items = [(k, words(rng, int(rng.integers(8, 40)), 300) + ". " + words(rng, int(rng.integers(4, 10)), 300) + ".") for k in range(25)]
    rows = [(i, words(rng, int(rng.integers(0, 300)), 300)) for i in range(60)]
    for i in range(60, 90):
        item = items[int(rng.integers(0, 25))][1]
        if i % 3 == 0:
            item = item.upper().replace(" ", "  ")
        if i % 3 == 1:
            w = item.split()
            w[int(rng.integers(0, len(w)))] = "changed"
            item = " ".join(w)
        rows.append((i, words(rng, int(rng.integers(0, 200)), 300) + "\n" + item + " " + words(rng, int(rng.integers(0, 200)), 300)))
    return items, rows


def brute(items, rows, s=D.Settings()):
    lists = D.word_lists([t for _, t in items])
    width = 2 * max(map(len, lists))
    half = width // 2
    out = {}
    for i, t in rows:
        w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
        for p in range(max(1, -(-len(w) // half) - 1)):
            passage = w[p * half:] if p + 1 == max(1, -(-len(w) // half) - 1) else w[p * half:p * half + width]
            held = D.grams(D.word_lists([" ".join(passage)])[0])
            for (k, text), mine, score in zip(items, lists, bm25([x for _, x in items], " ".join(passage))):
                n = D.answer_words(text, len(mine))
                q, a = (float(np.isin(g, held).mean()) for g in (D.grams(mine[:len(mine) - n]), D.grams(mine[len(mine) - n:])))
                if score >= s.score and q >= s.question and a >= s.answer:
                    out[i, k] = max(out.get((i, k), (0, 0, 0)), (round(score, 9), q, a))
    return out


def run(spark, docs, items, **kw):
    got = D.contaminated(docs, spark.createDataFrame(items, ITEMS), **kw).collect()
    return {(r.doc_id, r.item_id): (round(r.score, 9), r.question_overlap, r.answer_overlap) for r in got}


@pytest.mark.parametrize("slice_bytes", [D.SLICE_BYTES, 700])
def test_against_brute_force(spark, docs, slice_bytes):
    items, rows = corpus(np.random.default_rng(1))
    got = run(spark, docs(rows), items, slice_bytes=slice_bytes)
    assert got == brute(items, rows)
    assert {i for i, _ in got} >= set(range(60, 90, 3))


def test_bounds_drop_nothing_at_a_low_threshold(spark, docs):
    items, rows = corpus(np.random.default_rng(2))
    low = D.Settings(score=0.15, question=0.0, answer=0.0)
    assert run(spark, docs(rows), items, settings=low) == brute(items, rows, low)


def test_edge_cases(spark, docs):
    item = "which of these nine words is the right one. it is number nine here"
    rows = [(1, None), (2, ""), (3, item), (3, item), (4, "..."), (None, "x " * 50000 + item), (5, item.split(".")[0])]
    got = run(spark, docs(rows, clashing=True), [(7, item), (8, None), (9, ""), (10, "?!"), (7, item + " again")])
    assert {k[0] for k in got} == {3, None}
    assert run(spark, docs([]), [(1, item)]) == {} and run(spark, docs(rows), []) == {}


def test_short_items_and_scripts_without_spaces(spark, docs):
    rng = np.random.default_rng(3)
    items = [(n, " ".join(f"item{n}x{k}" for k in range(n))) for n in range(1, 7)]
    items += [(7, "水是什么颜色的"), (8, "ฟ้าสีอะไร"), (9, "東京は日本の首都ですか。はい、そうです"), (10, "𠀀𠀁"), (11, "火")]
    rows, want = [], set()
    for i, t in items:
        for k in range(3):
            before, after = words(rng, 60 * k), words(rng, 50 * k)
            if i > 6:
                before, after = before + " 我不知道" * (k > 0), "你呢" * (k > 0) + after
            rows.append((10 * i + k, before + " " * (i < 7) + t + " " * (i < 7) + after))
            want.add((10 * i + k, i))
    rows += [(200, "item4x0 item4x1 and item4x2 item4x3"), (201, "item2x1 item2x0"), (202, "水的颜色是什么"), (203, "word " * 9 + "item6x5")]
    brute_ = {(d, i) for d, text in rows for i, t in items if t in text}
    assert brute_ == want
    assert set(run(spark, docs(rows), items)) == want


def test_items_with_one_changed_word_are_found(spark, docs):
    items, _ = corpus(np.random.default_rng(1))
    items += [(100, "which one is it now. the small red"), (101, "one two three four five six rareword")]
    rows = []
    for k, t in items:
        w = t.split()
        for p in range(len(w)):
            rows.append((1000 * (k + 1) + p, "some words before " + " ".join([*w[:p], "changed", *w[p + 1:]]) + " and after"))
    got = run(spark, docs(rows), items, settings=D.Settings(edits=1))
    assert {(i, i // 1000 - 1) for i, _ in rows} <= set(got)
    assert set(run(spark, docs(rows), items)) <= set(got)


def test_real_items_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = {(r.doc_id, r.item_id) for r in docs.join(F.broadcast(items.select("item_id", F.col("text").alias("t"))), F.expr("instr(text, t) > 0")).collect()}
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()} >= want and want
