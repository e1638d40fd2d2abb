"""The ``opN_<name>`` queries over the given tables, with their parameters, and their DuckDB statements."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecast.llm import codes, decontaminate, jaccard_join, line_dedup, packing, prefix_trie, quality, recompression, repeats, simhash, toxicity, url_tree, wrapper
from ratecast.llm.common import documents
from ratecast.sources.tables import read_table

RULES = [
    url_tree.Rule("com", "/", "allow"),
    url_tree.Rule("example.com", "/en/", "block"),
    url_tree.Rule("www.example.com", "/en/", "allow"),
    url_tree.Rule("net", "/es/", "block"),
    url_tree.Rule("net", "/fr/", "block"),
]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_dedup(documents(spark, sf_dir), digest=True).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.lower(F.hex("kept")).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, edited, after = F.col("own"), F.col("edited"), F.col("next")
    return simhash.fingerprints(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", "edited_sha256",
        simhash.as_text(own["f0"], own["f1"]).alias("fingerprint"),
        simhash.as_text(edited["f0"], edited["f1"]).alias("edited_fingerprint"),
        simhash.likeness(own, edited).alias("near_edited"), simhash.likeness(own, after).alias("near_next"), "n_near", "near")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return decontaminate.contaminated(documents(spark, sf_dir), items, decontaminate.Settings(edits=1))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return toxicity.toxicity(documents(spark, sf_dir), labels).select("doc_id", "held_out", "score", "predicted")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return quality.quality(documents(spark, sf_dir), labels).select("doc_id", "held_out", "score", "predicted")


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return wrapper.extract(pages).select("page_id", "url", "text", "n_chars")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    return url_tree.url_filter(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), "byte_bpe_50k")


def trie_digests(trie: prefix_trie.Trie) -> DataFrame:
    """The nodes with a digest of the conversations that end at each."""
    nothing = hashlib.sha256(b"").hexdigest()
    return (trie.nodes.join(prefix_trie.ends_sha256(trie.ends), ["d0", "d1"], "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing))))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = prefix_trie.with_shared_beginnings(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    return trie_digests(prefix_trie.prefix_trie(turns, members)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.substring_dedup(documents(spark, sf_dir), digest=True).select(
        "doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))
    return codes.with_label_errors(coded).select("vec_id", "code", "error", "label_error",
                                                 F.lit(codes.books_sha256(books)).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_line_dedup, op2_suffix_dedup, op3_jaccard_join, op4_fingerprints, op5_decontamination, op6_toxicity, op7_quality, op8_extraction, op9_url_filter, op10_packing,
        op11_prefix_trie, op12_substring_dedup, op13_vector_codes)}


def _rule_case(what: str) -> str:
    """The longest rule that fits, as a CASE over host and path."""
    whens = " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, what)}'"
                     for r in sorted(RULES, key=lambda r: -len(r.name)))
    return f"CASE {whens} END"


#: op9 in DuckDB, with the settings of ``url_tree.TreeSettings``.
URL_SQL = f"""
WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '{url_tree.PARTS}', 1), '{url_tree.UPPER}', '{url_tree.LOWER}'), '') AS host,
                  coalesce(regexp_extract(url, '{url_tree.PARTS}', 2), '') AS path FROM pages),
p AS (SELECT *, {_rule_case("name")} AS rule, {_rule_case("verdict")} AS rv,
             list_transform(string_split(regexp_replace(path, '/+$', ''), '/'), lambda x: CASE WHEN regexp_full_match(x,
             '[0-9]+|[0-9]+\\.[A-Za-z0-9]+|[0-9a-fA-F]{{16,}}|[0-9a-fA-F]{{8}}-[0-9a-fA-F-]{{27}}') THEN '*' ELSE x END) AS parts FROM u),
g AS (SELECT host, parts, count(*) AS n, count(rule) AS labelled, count(*) FILTER (rv = 'block') AS blocked FROM p GROUP BY 1, 2),
s AS (SELECT host, parts, n, unnest(range(1, len(parts) + 1)) AS i FROM g),
seg AS (SELECT host, parts, n, i, parts[i] AS seg, parts[:i - 1] AS above FROM s),
kids AS (SELECT host, above, seg, sum(n) AS n FROM seg WHERE seg NOT IN ('*', '') GROUP BY 1, 2, 3),
variable AS (SELECT host, above FROM kids GROUP BY 1, 2 HAVING count(*) > 64 OR count(*) > 4 AND count(*) * 2 > sum(n)),
named AS (SELECT seg.host, seg.parts, string_agg(CASE WHEN seg <> '' AND v.host IS NOT NULL THEN '*' ELSE seg END, '/' ORDER BY i) AS template
          FROM seg LEFT JOIN variable v ON v.host = seg.host AND v.above = seg.above GROUP BY 1, 2),
t AS (SELECT g.host, template, sum(labelled) AS labelled, sum(blocked) AS blocked, regexp_replace(template, '[^/*]+', 'w', 'g') AS shape
      FROM g JOIN named USING (host, parts) GROUP BY 1, 2),
x AS (SELECT *, sum(blocked) OVER w / nullif(sum(labelled) OVER w, 0) AS share FROM t WINDOW w AS (PARTITION BY host, shape)),
b AS (SELECT *, CASE WHEN abs(blocked / nullif(labelled, 0) - share) <= 2.0::DOUBLE * sqrt(share * (1 - share) / nullif(labelled, 0))
                THEN shape ELSE template END AS branch FROM x),
m AS (SELECT host, template, sum(labelled) OVER w AS bl, (sum(blocked) OVER w + 4.0::DOUBLE * (SELECT sum(blocked) / greatest(sum(labelled), 1) FROM t))
             / (sum(labelled) OVER w + 4.0::DOUBLE) AS purity FROM b WINDOW w AS (PARTITION BY host, branch))
SELECT page_id, p.host, path, rule, coalesce(rv, CASE WHEN bl > 0 AND purity >= 0.8::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict, m.template, purity
FROM p JOIN named USING (host, parts) JOIN m ON m.host = p.host AND m.template = named.template
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.SQL, "op9_url_filter": URL_SQL, "op11_prefix_trie": prefix_trie.SQL, "op12_substring_dedup": recompression.SQL, "op13_vector_codes": codes.sql()}
