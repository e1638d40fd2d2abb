import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecast.llm import prefix_trie as P
from ratecast.llm import queries

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                      T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


@pytest.fixture
def conversations(spark):
    return lambda rows: spark.createDataFrame(rows, TURNS).withColumns({"d0": F.lit("x"), "depth": F.lit(1), "k": F.lit(2)}).repartition(3)


def in_order(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", xxhash.xxh64_intdigest(text or "", 42) - (1 << 64) * (xxhash.xxh64_intdigest(text or "", 42) >> 63), text or ""))
    return {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in by.items()}


def rebuilt(rows):
    own = in_order(rows)
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    return out


def brute(convs):
    nodes = defaultdict(list)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for x in nodes:
        if x:
            kids[x[:-1]].append(x)
    leaves, saved = {}, {}
    for x in sorted(nodes, key=len, reverse=True):
        leaves[x] = sum(leaves[k] for k in kids[x]) if kids[x] else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
        saved[x] = (len(nodes[x]) - 1) * words + sum(saved[k] for k in kids[x])
    out = []
    for x, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(x))
        out.append((min(m), len(x), min(nodes[x[:-1]]) if x else None, len(m), len(kids[x]), leaves[x], saved[x], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, members=None):
    trie = P.prefix_trie(df, members)
    rows = queries.trie_digests(trie).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in rows.collect()), key=str)


def sample(n, seed=3, ids=None):
    rng = np.random.default_rng(seed)
    rows = []
    for c in ids if ids is not None else range(n):
        for t in range(int(rng.integers(1, 7))):
            rows.append((int(c), t, ("user", "assistant")[t % 2], f"w{int(rng.integers(0, 2))} {'x ' * int(rng.integers(0, 2))}"))
    return [rows[i] for i in rng.permutation(len(rows))]


def test_against_brute_force(conversations):
    rows = sample(150)
    assert run(conversations(rows)) == brute(in_order(rows))


def test_levels_and_small_shards(conversations, monkeypatch):
    monkeypatch.setattr(P, "level_of", lambda n: F.greatest(F.ceil(F.log2(n.cast("double"))) - 1, F.lit(0)).cast("int"))  # FAN of 2
    monkeypatch.setattr(P, "SHARD", 8)
    rows = sample(120, seed=4) + [(1000 + i, t, "user", "the same") for i in range(60) for t in range(5)]
    assert run(conversations(rows)) == brute(in_order(rows))


def test_shared_beginnings(conversations):
    rows = sample(0, seed=5, ids=[*range(45), *range(70, 90), 205])
    turns, members = P.with_shared_beginnings(conversations(rows))
    assert run(turns, members) == brute(rebuilt(rows))


def test_one_conversation_over_many_tasks(conversations):
    rows = [(7, t, "user", f"turn {t}") for t in range(3000)] + [(8, t, "user", f"turn {t}") for t in range(2500)] + sample(20)
    assert run(conversations(rows)) == brute(in_order(rows))


def test_edge_cases(conversations):
    long = "word " * 30000
    rows = [(None, 0, "user", "lost"), (1, None, "user", "null turn first"), (1, 0, "user", "then"), (2, 1, None, None), (2, 1, "", ""),
            (3, 1, "", ""), (3, 1, "", ""), (4, 0, "b", "tie"), (4, 0, "a", "tie"), (4, 0, "a", "other"), (5, 0, "user", long), (6, 0, "user", long), (-21, 0, "user", "x")]
    assert run(conversations(rows)) == brute(in_order(rows))


def test_members_without_turns_and_empty_table(conversations, spark):
    rows = [(20, 0, "user", "a")]
    ids = spark.createDataFrame([(20,), (3,), (None,)], "conv_id long")
    assert run(conversations(rows), ids) == brute({20: [("user", "a")], 3: []})
    assert run(conversations([]), ids) == brute({20: [], 3: []})
    assert run(conversations([])) == []


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 2 ** 63, 5000).astype(np.uint64) for _ in range(2))
    slots = P.Slots(a, b)
    assert sorted(slots(a, b)) == list(range(5000))
    assert (slots(a, b + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError, match="equal digests"):
        P.Slots(np.repeat(a[:1], 2), np.repeat(b[:1], 2))


def test_chunks_of_ids(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 7)
    ends = spark.createDataFrame([(1, 2, i) for i in range(200, -50, -1)] + [(1, 3, 5)], "d0 long, d1 long, conv_id long").repartition(5)
    got = {(r.d0, r.d1): r.ends_sha256 for r in P.ends_sha256(ends).collect()}
    assert got == {(1, 2): hashlib.sha256(",".join(map(str, range(-49, 201))).encode()).hexdigest(), (1, 3): hashlib.sha256(b"5").hexdigest()}


def test_levels(spark):
    n = [1, 2, 256, 257, 65536, 65537, 2 ** 24, 2 ** 24 + 1]
    rows = spark.createDataFrame([(x,) for x in n], "n long").select(P.level_of(F.col("n"))).collect()
    assert [r[0] for r in rows] == [0, 0, 0, 1, 1, 2, 2, 3]
