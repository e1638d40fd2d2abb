"""Document fingerprints: SimHash in DataFrame expressions, and search within a Hamming radius.

A term is a lower-cased word with the word after it; each occurrence votes, so
a term weighs what it counts. A term's hash has 128 bits, and bit k of the
fingerprint is set if more than half of the votes set it. Votes are counted two
to a long (bit k in the lower half, bit k + 32 in the upper), so that 64 sums
make 128 bits and whole-stage code does the counting.

``near`` finds all fingerprints within a radius by block tables: the bits are cut
into blocks, and two such fingerprints differ in some block by no more than its
share of the radius. Each table is keyed by one block; a query looks up all keys
within that share, and what shares a key is compared in full. The number of
blocks follows from the number of entries. Equal fingerprints are one entry with
a count. The radius follows from the similarity that edited copies must have.

The next document (by descending id) is found within ranges of ids: each range
also holds the first row of the next range, so texts are shuffled once. Ranges are cut
at quantiles of the ids, null ids by the text's key, so each holds about as many rows.

Defined cases: a null text is an empty one, whose only term is the empty word;
a null id comes after all others; rows equal in id and text are one document,
returned once; a table of one row is its own next document.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratecast.llm.common import keyed, partitions, stored

BITS = 128
#: Jaccard similarity of five-word shingles from which on edited copies are to be found.
SIMILARITY = 0.75
LANES = 0x100000001
MAX_RANGES = 65536


def terms(text: Column) -> Column:
    """Hashes of the terms of a text, one per word."""
    words = F.transform(F.split(F.lower(text), r"\s+"), lambda w: F.xxhash64(w))
    # the array of one array binds the words to a name: else they would be split again for each word
    pairs = F.transform(F.array(words), lambda ws: F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1))))
    return F.get(pairs, 0)


def votes(term: Column) -> list[Column]:
    """The 64 sums of votes over the rows of a group."""
    halves = (term, F.xxhash64(F.lit("second"), term))
    return [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(LANES))).alias(f"v{i}_{k}")
            for i, h in enumerate(halves) for k in range(32)]


def fingerprint(count: Column) -> list[Column]:
    """The two longs of a fingerprint, from the sums and the number of votes."""
    out = []
    for i in range(2):
        bits = F.lit(0).cast("long")
        for k in range(32):
            low = F.col(f"v{i}_{k}").bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > count
            high = F.shiftrightunsigned(F.col(f"v{i}_{k}"), 32) * 2 > count
            bits = bits.bitwiseOR(F.when(low, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
            bits = bits.bitwiseOR(F.shiftleft(F.when(high, F.lit(1)).otherwise(F.lit(0)).cast("long"), k + 32))
        out.append(bits.alias(f"f{i}"))
    return out


def as_text(a: Column, b: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def distance(a: Column, b: Column) -> Column:
    """Differing bits of two fingerprints (structs of two longs)."""
    return F.bit_count(a["f0"].bitwiseXOR(b["f0"])) + F.bit_count(a["f1"].bitwiseXOR(b["f1"]))


def likeness(a: Column, b: Column) -> Column:
    return 1 - distance(a, b) / F.lit(float(BITS))


def with_ranges(docs: DataFrame) -> DataFrame:
    """Rows with ``rng`` (ascending with the id) and ``guest``: whether the row is only there as the next one.

    At most MAX_RANGES ranges, and as many for null ids: that bounds the table of their first rows, which is broadcast.
    """
    spark = docs.sparkSession
    n, nulls = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    ranges = max(1, min(MAX_RANGES, n // 64, max(8 * partitions(spark), n // 2048)))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)] or [0.5], max(10000, 10 * ranges))).first()[0]
    cuts = sorted(set(cuts or [0]))
    step = math.isqrt(len(cuts))

    def longs(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")

    def up_to(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= F.col("doc_id")))

    coarse = up_to(longs(cuts[::step]))
    fine = (coarse - 1) * step + up_to(F.slice(longs(cuts), F.greatest((coarse - 1) * step + 1, F.lit(1)), step))
    # null ids come below all others, dealt by the text's key
    bits = max(1, min(16, (nulls * ranges // max(n, 1)).bit_length()))
    null = F.shiftright("text_key", 64 - bits) - (1 << (bits - 1))
    rng = F.when(F.col("doc_id").isNull(), null).when(coarse == 0, F.lit(0)).otherwise(fine).cast("long")
    docs = docs.withColumn("rng", rng)
    tops = docs.groupBy("rng").agg(F.max(F.struct(F.col("doc_id"), F.col("text_key"))).alias("top"))
    order = Window.orderBy("rng")  # over the ranges, not the rows
    tops = tops.select("top", F.coalesce(F.lead("rng").over(order), F.first("rng").over(order)).alias("to"))
    tops = tops.select(F.col("top.doc_id").alias("_id"), F.col("top.text_key").alias("_key"), "to")
    guests = (docs.join(F.broadcast(tops), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
              .select("doc_id", "text", "text_key", F.col("to").alias("rng"), F.lit(True).alias("guest")))
    return docs.withColumn("guest", F.lit(False)).unionByName(guests)


def simhash(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, own, edited, next``: the last three are fingerprints (f0, f1).

    ``edited`` is the text whose second half is replaced by the beginning of the next document.
    """
    order = Window.partitionBy("rng").orderBy("guest", F.desc("doc_id"), F.desc("text_key"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    row_before = F.lag(F.struct("guest", "doc_id", "text_key")).over(order)
    # repeated rows are one document: they lie next to each other
    one = with_ranges(keyed(docs)).withColumn("again", row_before.eqNullSafe(F.struct("guest", "doc_id", "text_key"))).where(~F.col("again")).drop("again")
    d = (one.withColumn("after", F.coalesce(F.lead("text").over(order), F.col("text")))
         .withColumn("n_chars", n.cast("long"))
         .withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("after", F.lit(1), half)))
         .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)))
    row = ["rng", "guest", "doc_id", "text_key", "n_chars", "edited_sha256"]
    both = F.concat(F.transform(terms(F.col("text")), lambda t: F.struct(F.lit(0).alias("of"), t.alias("term"))),
                    F.transform(terms(F.col("edited")), lambda t: F.struct(F.lit(1).alias("of"), t.alias("term"))))
    counted = (d.select(*row, F.explode(both).alias("t")).select(*row, "t.of", "t.term")
               .groupBy(*row, "of").agg(F.count("*").alias("n"), *votes(F.col("term"))))
    prints = counted.select(*row, "of", F.struct(*fingerprint(F.col("n"))).alias("f"))
    per_doc = prints.groupBy(*row).agg(F.max(F.when(F.col("of") == 0, F.col("f"))).alias("own"),
                                       F.max(F.when(F.col("of") == 1, F.col("f"))).alias("edited"))
    return (per_doc.withColumn("next", F.coalesce(F.lead("own").over(order), F.col("own")))
            .where(~F.col("guest")).select("doc_id", "n_chars", "edited_sha256", "own", "edited", "next"))


def radius_for(similarity: float, shingle: int = 5) -> int:
    """Bits within which edited copies of at least this Jaccard similarity of word shingles lie.

    Words changed one by one, a share x of them, leave (1 - shingle x) / (1 + shingle x) of the shingles and 1 - 2 x of
    the terms; the angle of that cosine gives the mean of the differing bits, and two deviations are added.
    """
    x = (1 - similarity) / (shingle * (1 + similarity))
    share = math.acos(max(-1.0, 1 - 2 * x)) / math.pi
    return min(BITS, math.ceil(BITS * share + 2 * math.sqrt(BITS * share * (1 - share))))


def tables_for(radius: int, n: int) -> list[tuple[int, int, int, int]]:
    """(long, first bit, width, allowance) of the block tables that make a search among ``n`` entries cheapest.

    The allowances and one for each table add up to radius + 1, so two fingerprints within the radius differ in
    some block by no more than its allowance: the search is exact for every choice.
    """
    def made(blocks: int) -> list[tuple[int, int, int, int]]:
        half, out = blocks // 2, []
        for i in range(blocks):
            long, k = divmod(i, half)
            first = 64 * k // half
            out.append((long, first, 64 * (k + 1) // half - first, (radius + 1) // blocks - 1 + (i < (radius + 1) % blocks)))
        return [t for t in out if t[3] >= 0]

    def cost(tables: list[tuple[int, int, int, int]]) -> float:
        return sum(probes(w, a) * (1 + n / 2 ** w) for _, _, w, a in tables)

    return min((made(b) for b in range(2, 66, 2)), key=cost)


def probes(width: int, allowance: int) -> int:
    return sum(math.comb(width, k) for k in range(min(width, allowance) + 1))


def near(queries: DataFrame, entries: DataFrame, radius: int) -> DataFrame:
    """Pairs of different or equal fingerprints within the radius: (q, e, bits), each pair once.

    Both sides have one struct column ``own``; they are made distinct first.
    """
    q, e = queries.select(F.col("own").alias("q")).distinct(), entries.select(F.col("own").alias("e")).distinct()
    tables = tables_for(radius, e.count())

    def block(own: str, long: int, first: int, width: int) -> Column:
        return F.shiftrightunsigned(F.col(own)[f"f{long}"], first).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))

    def key(i: int, value: Column) -> Column:
        return F.struct(F.lit(i).alias("table"), value.alias("block"))

    def flips(width: int, allowance: int) -> Column:
        # read from one literal text: thousands of literal columns would take long to analyse
        masks = [sum(1 << b for b in bits) for k in range(allowance + 1) for bits in itertools.combinations(range(width), k)]
        return F.split(F.lit(",".join(str(m - (m >> 63 << 64)) for m in masks)), ",").cast("array<long>")

    def looked_up(i: int, value: Column, masks: Column) -> Column:
        return F.transform(masks, lambda m: key(i, value.bitwiseXOR(m)))

    probed = F.concat(*[looked_up(i, block("q", g, at, w), flips(w, a)) for i, (g, at, w, a) in enumerate(tables)])
    held = F.array(*[key(i, block("e", g, at, w)) for i, (g, at, w, _) in enumerate(tables)])
    n = partitions(queries.sparkSession)
    q = q.repartition(n).select("q", F.explode(probed).alias("k")).select("q", "k.*")
    e = e.select("e", F.explode(held).alias("k")).select("e", "k.*")
    # a pair is made in the first table that finds it
    first = F.coalesce(*[F.when(F.bit_count(block("q", g, at, w).bitwiseXOR(block("e", g, at, w))) <= a, F.lit(i))
                         for i, (g, at, w, a) in enumerate(tables)])
    bits = distance(F.col("q"), F.col("e"))
    # exploded sides are larger than any estimate: never broadcast one
    return (q.join(e.hint("merge"), ["table", "block"]).where((bits <= radius) & (first == F.col("table")))
            .select("q", "e", bits.alias("bits")))


def fingerprints(docs: DataFrame, radius: int = radius_for(SIMILARITY), every: int = 50) -> DataFrame:
    """All documents with their fingerprints; for the query rows (ids divisible by ``every``), else null, ``n_near``:
    how many documents, itself included, have a fingerprint within the radius, and ``near``: these fingerprints, sorted.

    Documents of one fingerprint are a class, named by it once however many they are; their ids are the rows that
    have this fingerprint.
    """
    p = stored(simhash(docs), "simhash")
    query = p.where(F.col("doc_id") % every == 0)
    count = p.groupBy("own").agg(F.count("*").alias("n"))
    found = (near(query, p, radius).join(count.withColumnRenamed("own", "e"), "e")
             .groupBy("q").agg(F.sum("n").alias("n_near"), F.sort_array(F.collect_list(as_text(F.col("e.f0"), F.col("e.f1")))).alias("near")))
    hits = query.join(found, query["own"] == found["q"], "left").select("doc_id", *p.columns[1:], "n_near", "near")
    rest = p.where(~F.coalesce(F.col("doc_id") % every == 0, F.lit(False)))
    return hits.unionByName(rest.withColumns({"n_near": F.lit(None).cast("long"), "near": F.lit(None).cast("array<string>")}))
