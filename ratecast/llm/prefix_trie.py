"""Prefix trie of conversations in minimal-perfect-hash node tables.

A node is a distinct sequence of a conversation's first turns (role and text);
the root is the empty sequence. Spark enumerates the distinct prefixes: turns are numbered and a
running pair of 64-bit polynomial hashes gives every prefix a 128-bit digest, its parent's
digest along with it. Rows are range-partitioned by (conversation, turn), so one
conversation may lie in many tasks; what a task's first conversation had before
is carried over from the tasks before (one row a task). Members are counted by
digest, combined before the shuffle, so a first turn that a third of all conversations
share is a row a task.

The trie is then cut into pieces. A node's level is the power of FAN that bounds its member
count; a piece is a maximal connected set of nodes of one level, and as at most
FAN nodes of a level lie at one depth of a piece, it has at most FAN times its
depth nodes however large the trie is. The pieces of a level are dealt to tasks, a few
whole pieces make a shard. In a shard the node digests get the slots of a minimal
perfect hash (levels of bit tables; every look-up is verified against the digest
that owns the slot), counts are scattered to flat arrays at these slots, and
sums run up the array of parent slots, deepest nodes first. The piece's top passes its sums on to
the next level, so there are as many rounds as levels (two for 65,536 conversations, four for 4 * 10**9), not as
depths.

Digests are verified: all rows of one digest must have the same depth,
parent and last turn, else an error is raised.

Order of turns: ``turn`` (null first), then role, then a hash of the text. Defined cases: null role or text is
empty; rows with a null ``conv_id`` belong to no conversation and are left out;
repeated rows are turns of their own; members without a turn end at the root; an empty table has no node, not even a root;
columns not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecast.llm.bytes_hash import mix
from ratecast.llm.common import partitions, stored

#: Fixed values of the digests: two odd multipliers.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MASK = 2 ** 64 - 1
FAN = 256
#: Nodes after which a shard is closed (at the end of a piece).
SHARD = 1 << 16
WORDS = r"[^\x20\x09-\x0D]+"
#: Consecutive ids of one prefix that travel as one row.
CHUNK = 4096


class Trie(NamedTuple):
    """``nodes``: ``d0, d1`` (digest; the root's is 0, 0), ``depth, conv_id`` (smallest member), ``parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens``. ``ends``: ``d0, d1, conv_id`` of the node at which each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


# turns in order


class Powers:
    """Powers of an odd number modulo 2**64, any exponent, from two short tables."""

    LOW = 1 << 16

    def __init__(self, base: int):
        self.low = np.full(self.LOW, base, np.uint64)
        self.low[0] = 1
        self.low = np.cumprod(self.low, dtype=np.uint64)
        self.step = pow(base, self.LOW, 2 ** 64)
        self.high = np.ones(1, np.uint64)

    def __call__(self, e: np.ndarray) -> np.ndarray:
        top = int(e.max(initial=0)) // self.LOW
        if top >= len(self.high):
            self.high = np.full(2 * top + 1, self.step, np.uint64)
            self.high[0] = 1
            self.high = np.cumprod(self.high, dtype=np.uint64)
        return self.low[e % self.LOW] * self.high[e // self.LOW]


def _local_prefixes(rows: DataFrame, carry: list[str]) -> DataFrame:
    """``part, conv_id, k, p0, p1, q0, q1`` and carried columns: number and hashes within the task (q: without the row itself)."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in carry)
    names = ["part", "conv_id", "k", "p0", "p1", "q0", "q1", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, powers = TaskContext.get().partitionId(), [Powers(b) for b in BASES]
        last, number, sums = None, 0, [np.zeros(1, np.uint64)] * 2
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            conv = b.column("conv_id").to_numpy()
            goes_on = last is not None and conv[0] == last
            new = np.concatenate(([True], conv[1:] != conv[:-1]))
            start = np.flatnonzero(new)[np.cumsum(new) - 1]
            k = np.arange(n) - start + 1
            if goes_on:
                k[start == 0] += number
            out = []
            for i in (0, 1):
                term = b.column(f"t{i}").to_numpy().view(np.uint64) * powers[i](k)
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)))
                p = total[1:] - total[start]
                if goes_on:
                    p[start == 0] += sums[i][0]
                out.append((p, p - term))
                sums[i] = p[-1:]
            last, number = conv[-1], int(k[-1])
            arrays = [pa.array(np.full(n, part, np.int32)), b.column("conv_id"), pa.array(k)]
            arrays += [pa.array(x.view(np.int64)) for x in (out[0][0], out[1][0], out[0][1], out[1][1])]
            yield pa.RecordBatch.from_arrays([*arrays, *(b.column(c) for c in carry)], names=names)

    schema = "part int, conv_id long, k long, p0 long, p1 long, q0 long, q1 long" + (f", {kind}" if kind else "")
    return rows.mapInArrow(run, schema)


def prefixes(rows: DataFrame, *carry: str) -> DataFrame:
    """Turns with their number in the conversation (``k``, from 1) and digests up to (``p0, p1``) and before (``q0, q1``) them.

    ``rows``: ``conv_id, turn, role, tie, t0, t1`` and the carried columns; stored.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    local = stored(_local_prefixes(dealt, list(carry)), "turn_prefixes")
    # one row a task, in the order of the tasks
    ends = local.groupBy("part").agg(F.min("conv_id").alias("lo"), F.max("conv_id").alias("hi")).orderBy("part").collect()
    cut = {b.lo for a, b in zip(ends, ends[1:]) if a.hi == b.lo}
    if not cut:
        return local.drop("part")
    here = (local.where(F.col("conv_id").isin(list(cut))).groupBy("conv_id", "part")
            .agg(F.max(F.struct("k", "p0", "p1")).alias("end")).orderBy("conv_id", "part").collect())
    before: dict[tuple[int, int], tuple[int, int, int]] = {}
    at: dict[int, tuple[int, int, int]] = {}
    for r in here:
        k, sums = at.get(r.conv_id, (0, 0, 0))[0], at.get(r.conv_id, (0, 0, 0))[1:]
        before[r.part, r.conv_id] = (k, *sums)
        at[r.conv_id] = (k + r.end.k, *((s + pow(b, k, 2 ** 64) * (p & MASK)) & MASK for s, b, p in zip(sums, BASES, (r.end.p0, r.end.p1))))
    conv_ids = np.array(sorted(cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            conv, part = b.column("conv_id").to_numpy(), b.column("part").to_numpy()
            some = np.flatnonzero(np.isin(conv, conv_ids))
            if some.size:
                cols = {c: b.column(c).to_numpy().copy() for c in ("k", "p0", "p1", "q0", "q1")}
                for p, c in set(zip(part[some].tolist(), conv[some].tolist())):
                    rows_here = some[(part[some] == p) & (conv[some] == c)]
                    k, *sums = before[p, c]
                    cols["k"][rows_here] += k
                    for i, (s, base) in enumerate(zip(sums, BASES)):
                        factor, add = np.array([pow(base, k, 2 ** 64)], np.uint64), np.array([s], np.uint64)
                        for name in (f"p{i}", f"q{i}"):
                            x = cols[name].view(np.uint64)
                            x[rows_here] = x[rows_here] * factor + add
                b = pa.RecordBatch.from_arrays([pa.array(cols[c]) if c in cols else b.column(c) for c in b.schema.names], names=b.schema.names)
            yield b

    return local.mapInArrow(run, local.schema).drop("part")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, tie`` with nulls of role and text as empty strings."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"), F.xxhash64(text).alias("tie"))


def with_shared_beginnings(conversations: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of their group's first, and the ids of all of them.

    Conversation c is the first h turns of conversation ``c - c % group`` (all if
    it has fewer, none if there is no such conversation), then its own turns
    after its first h; h is ``crc32(decimal c) % heads``. Returns ``conv_id, turn, role, text`` and ``conv_id``.
    Negative ids divide toward zero, as ``%`` does in SQL.
    """
    rows = ordered_turns(conversations).withColumns({"t0": F.lit(0).cast("long"), "t1": F.lit(0).cast("long")})
    own = prefixes(rows, "role", "text").select("conv_id", F.col("k").alias("turn"), "role", "text")
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    members = own.where("turn = 1").select("conv_id")
    first = own.where((F.col("conv_id") % group == 0) & (F.col("turn") < heads)).withColumnRenamed("conv_id", "base")
    shared = (members.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base")
              .where(F.col("turn") <= h).select("conv_id", "turn", "role", "text"))
    return own.where(F.col("turn") > h).unionByName(shared), members


# node tables


class Slots:
    """Minimal perfect hash of distinct 128-bit keys: slot 0 .. n - 1, with the key that owns each slot.

    A level is a bit table; a key that is alone at its place in the table gets the place's rank, the
    others go on to the next level with another seed.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        n = len(a)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.a, self.b = np.empty(n, np.uint64), np.empty(n, np.uint64)
        rest, base = np.arange(n), 0
        while rest.size:
            if len(self.levels) > 64:
                raise ValueError("equal digests in one node table")
            place = self._place(a[rest], b[rest], len(self.levels), 2 * rest.size + 1)
            alone = np.bincount(place, minlength=2 * rest.size + 1) == 1
            rank = base + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            placed = alone[place]
            slot = rank[place[placed]]
            self.a[slot], self.b[slot] = a[rest[placed]], b[rest[placed]]
            base += int(alone.sum())
            rest = rest[~placed]

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, seed: int, size: int) -> np.ndarray:
        return (mix(a ^ mix(b + np.uint64(2 * seed + 1))) % np.uint64(size)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that own none."""
        found = np.full(len(a), -1)
        rest = np.arange(len(a))
        for seed, (alone, rank) in enumerate(self.levels):
            if not rest.size:
                break
            place = self._place(a[rest], b[rest], seed, len(alone))
            hit = alone[place]
            slot = rank[place[hit]]
            who = rest[hit]
            own = (self.a[slot] == a[who]) & (self.b[slot] == b[who])
            found[who[own]] = slot[own]
            rest = rest[~hit]
        return found


def accumulate(nodes: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(children, leaves, saved, is a top) of the nodes of a shard, in their given order.

    ``nodes``: ``d0, d1, u0, u1`` (digest and parent's), ``depth``, ``value``, and ``kids, leaves, saved`` from pieces below.
    """
    key = {c: nodes[c].view(np.uint64) for c in ("d0", "d1", "u0", "u1")}
    slots = Slots(key["d0"], key["d1"])
    at = slots(key["d0"], key["d1"])
    n = len(at)
    parent = np.full(n, -1)  # by slot, as all arrays below
    parent[at] = slots(key["u0"], key["u1"])
    depth, kids, leaves, saved = (np.empty(n, np.int64) for _ in range(4))
    depth[at], kids[at], leaves[at], saved[at] = nodes["depth"], nodes["kids"], nodes["leaves"], nodes["saved"] + nodes["value"]
    inner = parent >= 0
    np.add.at(kids, parent[inner], 1)
    leaves[kids == 0] = 1
    order = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], np.diff(depth[order]) != 0, [True]))) if n else np.zeros(1, np.int64)
    for lo, hi in zip(edges[:-1], edges[1:]):
        s = order[lo:hi]
        s = s[parent[s] >= 0]
        np.add.at(leaves, parent[s], leaves[s])
        np.add.at(saved, parent[s], saved[s])
    return kids[at], leaves[at], saved[at], ~inner[at]


SUMMED = "d0 long, d1 long, u0 long, u1 long, depth long, n_children long, n_leaves long, saved_tokens long, top boolean"


def _summed(nodes: DataFrame) -> DataFrame:
    """The nodes of one level with what their subtrees sum up to."""
    cols = ["d0", "d1", "u0", "u1", "depth", "value", "kids", "leaves", "saved"]

    def of(parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        nodes = {c: np.concatenate([p[c] for p in parts]) for c in cols}
        kids, leaves, saved, top = accumulate(nodes)
        return pa.RecordBatch.from_arrays([*(pa.array(nodes[c]) for c in cols[:5]), pa.array(kids), pa.array(leaves), pa.array(saved), pa.array(top)],
                                          names=["d0", "d1", "u0", "u1", "depth", "n_children", "n_leaves", "saved_tokens", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        size, last = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            root = np.column_stack([b.column(c).to_numpy() for c in ("r0", "r1")])
            new = np.concatenate(([last is None or (root[0] != last).any()], (root[1:] != root[:-1]).any(1)))
            last = root[-1]
            part = {c: b.column(c).to_numpy() for c in cols}
            at = 0
            for cut in np.flatnonzero(new):  # a shard may be closed where a piece begins
                if size + cut - at >= SHARD:
                    held.append({c: x[at:cut] for c, x in part.items()})
                    yield of(held)
                    held, size, at = [], 0, cut
            held.append({c: x[at:] for c, x in part.items()})
            size += b.num_rows - at
        if size:
            yield of(held)

    n = partitions(nodes.sparkSession)
    return nodes.repartition(n, "r0", "r1").sortWithinPartitions("r0", "r1").select("r0", "r1", *cols).mapInArrow(run, SUMMED)


def level_of(n: Column) -> Column:
    """The least l with ``n <= FAN ** (l + 1)``."""
    return F.greatest(F.ceil(F.length(F.hex(n - 1)) / F.lit(2)) - 1, F.lit(0)).cast("int")


def prefix_trie(conversations: DataFrame, members: DataFrame | None = None) -> Trie:
    """Trie of ``conv_id, turn, role, text``; ``members`` (``conv_id``) names conversations that may have no turn."""
    spark = conversations.sparkSession
    turns = ordered_turns(conversations)
    hashed = turns.select("conv_id", "turn", "role", "tie", F.xxhash64(F.lit("first"), "role", "text").alias("t0"),
                          F.xxhash64(F.lit("second"), "role", "text").alias("t1"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"))
    path = prefixes(hashed, "t0", "t1", "words").select(
        "conv_id", F.col("k").alias("depth"), F.col("p0").alias("d0"), F.col("p1").alias("d1"), F.col("q0").alias("u0"), F.col("q1").alias("u1"),
        "t0", "t1", "words")
    path = stored(path, "prefix_path")

    same = [F.min(c) == F.max(c) for c in ("depth", "u0", "u1", "t0", "t1")]
    verified = same[0] & same[1] & same[2] & same[3] & same[4]
    nodes = path.groupBy("d0", "d1").agg(
        F.when(verified, F.count("*")).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("long")).alias("n_convs"),
        F.min("conv_id").alias("first"), F.min("words").alias("words"))
    nodes = stored(nodes.withColumn("level", level_of(F.col("n_convs"))), "prefix_nodes")

    # every conversation's way through the nodes; where it enters a level, a piece begins
    way = stored(path.select("conv_id", "depth", "d0", "d1", "u0", "u1").join(nodes, ["d0", "d1"]), "prefix_way")
    entered = way.groupBy("conv_id", "level").agg(F.min(F.struct("depth", "d0", "d1")).alias("root"))
    above = way.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("first").alias("above"))
    own = way.where("conv_id = first").join(entered, ["conv_id", "level"]).join(above, ["conv_id", "depth"], "left")
    own = stored(own.select("d0", "d1", "u0", "u1", "depth", "conv_id", F.col("above").alias("parent_conv_id"), "n_convs", "level",
                            F.col("root.d0").alias("r0"), F.col("root.d1").alias("r1"),
                            ((F.col("n_convs") - 1) * F.col("words")).alias("value")), "prefix_pieces")

    top_level = own.agg(F.max("level")).first()[0]
    summed: DataFrame | None = None
    for level in range(-1 if top_level is None else top_level + 1):
        here = own.where(F.col("level") == level)
        zero = F.lit(0).cast("long")
        if summed is None:
            here = here.withColumns({"kids": zero, "leaves": zero, "saved": zero})
        else:
            below = summed.where("top").groupBy(F.col("u0").alias("d0"), F.col("u1").alias("d1")).agg(
                F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
            here = here.join(below, ["d0", "d1"], "left").fillna(0, ["kids", "leaves", "saved"])
        done = stored(_summed(here), f"prefix_sums_{level}")
        summed = done if summed is None else summed.unionByName(done)

    last = path.groupBy("conv_id").agg(F.max(F.struct("depth", "d0", "d1")).alias("end"))
    ends = last.select("end.d0", "end.d1", "conv_id")
    everyone = last.select("conv_id")
    if members is not None:
        everyone = members.select("conv_id").where("conv_id IS NOT NULL").distinct()
        zero = F.lit(0).cast("long")
        ends = ends.unionByName(everyone.join(last, "conv_id", "left_anti").select(zero.alias("d0"), zero.alias("d1"), "conv_id"))
    return Trie(_with_root(own, summed, everyone, spark), ends)


NODES = "d0 long, d1 long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _with_root(own: DataFrame, summed: DataFrame | None, everyone: DataFrame, spark) -> DataFrame:
    n, smallest = everyone.agg(F.count("*"), F.min("conv_id")).first()
    if not n:
        return spark.createDataFrame([], NODES)
    if summed is None:
        return spark.createDataFrame([(0, 0, 0, smallest, None, n, 0, 1, 0)], NODES)
    kids, leaves, saved = summed.where("depth = 1").agg(F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    root = spark.createDataFrame([(0, 0, 0, smallest, None, n, kids, leaves, saved)], NODES)
    nodes = own.join(summed.select("d0", "d1", "n_children", "n_leaves", "saved_tokens"), ["d0", "d1"])
    parent = F.when(F.col("depth") == 1, F.lit(smallest)).otherwise(F.col("parent_conv_id")).alias("parent_conv_id")
    return nodes.select("d0", "d1", "depth", "conv_id", parent, "n_convs", "n_children", "n_leaves", "saved_tokens").unionByName(root)


def ends_sha256(ends: DataFrame) -> DataFrame:
    """``d0, d1, ends_sha256``: SHA-256 of the ids that end at a node, ascending and joined by commas.

    Ids are dealt out by range and joined to chunks; a node's chunks are then hashed one after the other, so the
    task that a common node falls to reads a row for CHUNK ids and holds one chunk.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        node = None

        def row() -> tuple:
            return (*node, held[0], ",".join(map(str, held)))

        for b in batches:
            rows = []
            for d0, d1, i in zip(*(b.column(c).to_pylist() for c in ("d0", "d1", "conv_id"))):
                if held and ((d0, d1) != node or len(held) >= CHUNK):
                    rows.append(row())
                    held = []
                node = (d0, d1)
                held.append(i)
            yield _batch(rows, ("d0", "d1", "least", "ids"))
        if held:
            yield _batch([row()], ("d0", "d1", "least", "ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, h = None, None
        for b in batches:
            rows = []
            for d0, d1, ids in zip(*(b.column(c).to_pylist() for c in ("d0", "d1", "ids"))):
                if (d0, d1) == node:
                    h.update(b",")
                else:
                    if node is not None:
                        rows.append((*node, h.hexdigest()))
                    node, h = (d0, d1), hashlib.sha256()
                h.update(ids.encode())
            yield _batch(rows, ("d0", "d1", "ends_sha256"))
        if node is not None:
            yield _batch([(*node, h.hexdigest())], ("d0", "d1", "ends_sha256"))

    n = partitions(ends.sparkSession)
    chunked = (ends.repartitionByRange(n, "conv_id").sortWithinPartitions("d0", "d1", "conv_id").select("d0", "d1", "conv_id")
               .mapInArrow(chunks, "d0 long, d1 long, least long, ids string"))
    return (chunked.repartition(n, "d0", "d1").sortWithinPartitions("d0", "d1", "least")
            .mapInArrow(digests, "d0 long, d1 long, ends_sha256 string"))


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = [pa.string() if n in ("ids", "ends_sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))


#: The trie of ``with_shared_beginnings`` in DuckDB, on the prefixes themselves.
SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)),
             4294967295) % 4 AS h FROM t),
r AS (SELECT c.conv_id, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE k > h
      UNION ALL SELECT c.conv_id, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 WHERE k <= h),
l AS (SELECT c.conv_id, list({'r': role, 't': text} ORDER BY k) FILTER (k IS NOT NULL) AS s FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, len(coalesce(s, [])) AS n, unnest(range(0, len(coalesce(s, [])) + 1)) AS d, coalesce(s, []) AS s FROM l),
m AS MATERIALIZED (SELECT conv_id, n, d, s[:d] AS pre, s[:d - 1] AS up, CASE WHEN d > 0 THEN len(regexp_extract_all(s[d].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS words FROM p),
g AS MATERIALIZED (SELECT d, pre, min(conv_id) AS conv_id, min(CASE WHEN d > 0 THEN up END) AS up, count(*) AS n_convs, (count(*) - 1) * min(words) AS value,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM m GROUP BY d, pre),
kids AS (SELECT d - 1 AS d, up AS pre, count(*) AS n FROM g WHERE d > 0 GROUP BY ALL),
k AS MATERIALIZED (SELECT g.*, coalesce(kids.n, 0) AS n_children FROM g LEFT JOIN kids ON kids.d = g.d AND kids.pre = g.pre),
own AS (SELECT m.conv_id, m.d, m.pre, CASE WHEN k.conv_id = m.conv_id THEN value ELSE 0 END AS value, (k.conv_id = m.conv_id AND n_children = 0)::INT AS leaf
        FROM m JOIN k ON k.d = m.d AND k.pre = m.pre),
below AS (SELECT d, pre, sum(value) OVER w AS value, sum(leaf) OVER w AS leaves FROM own WINDOW w AS (PARTITION BY conv_id ORDER BY d DESC)),
s AS (SELECT d, pre, sum(value)::BIGINT AS saved_tokens, sum(leaves)::BIGINT AS n_leaves FROM below GROUP BY d, pre)
SELECT k.conv_id, k.d AS depth, q.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, k.ends_sha256
FROM k JOIN s ON s.d = k.d AND s.pre = k.pre LEFT JOIN k q ON q.d = k.d - 1 AND q.pre = k.up
"""
