"""URL filter: explicit host/path rules, and a path-template tree that generalises them.

Per host the path segments form a tree. A segment that is a number, a hash or
a numbered file is a variable by its form; below any node with many different
literal children, or with about as many as it has URLs, the children are a
variable too. Variables become wildcards, so each URL has a template such as
``/en/*``. URLs that a rule judges are the labelled ones: sibling templates of
one host and shape whose shares of blocked URLs do not differ beyond chance are
merged, and a template is rejected if its smoothed share is high enough and
rests on labelled URLs. A rule's verdict always beats its template's.

Everything is DataFrame operations. URLs are counted per (host, typed path)
before anything else is shuffled, so a host with a third of all rows is a few
counts; only the last join carries single URLs, and its hot keys can be split.

Defined cases: a null url or one without ``://`` has an empty host and path;
equal rows are kept as they are; a template without labelled URLs is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WILD = "*"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TreeSettings:
    """``max_children``: literal children beyond which a node's children are a variable (also: more than
    half as many as its URLs, if over ``min_children``). ``z``: standard errors within which a branch counts as
    similar. ``weight``: pseudo-URLs of the overall share in the smoothing. ``reject``: share that rejects."""

    max_children: int = 64
    min_children: int = 4
    z: float = 2.0
    weight: float = 4.0
    reject: float = 0.8


#: After the first "://": the host, then the path.
PARTS = r"://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(name, verdict) of the longest rule that fits; null where none does."""
    fitting = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        fitting = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(fitting)
    return fitting


def typed(path: Column) -> Column:
    """The path with each segment that is a variable by its form replaced by a wildcard."""
    form = r"(?<=/)([0-9]+|[0-9]+\.[A-Za-z0-9]+|[0-9a-fA-F]{16,}|[0-9a-fA-F]{8}-[0-9a-fA-F-]{27})(?=/|$)"
    return F.regexp_replace(path, form, WILD)


def templates(paths: DataFrame, s: TreeSettings) -> DataFrame:
    """Template of every (host, typed): paths has host, typed, n, labelled, blocked."""
    seg = (paths.select("host", "typed", "n", F.posexplode(F.split("typed", "/")).alias("at", "seg"))
           .withColumn("above", F.array_join(F.slice(F.split("typed", "/"), F.lit(1), F.col("at")), "/")))
    children = seg.where((F.col("seg") != WILD) & (F.col("seg") != "")).groupBy("host", "above", "seg").agg(F.sum("n").alias("n"))
    variable = (children.groupBy("host", "above").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"))
                .where((F.col("kinds") > s.max_children)
                       | (F.col("kinds") > s.min_children) & (F.col("kinds") * 2 > F.col("n")))
                .select("host", "above", F.lit(True).alias("variable")))
    wild = F.when((F.col("seg") != "") & F.col("variable"), WILD).otherwise(F.col("seg"))
    return (seg.join(variable, ["host", "above"], "left")
            .groupBy("host", "typed").agg(F.array_sort(F.collect_list(F.struct("at", wild.alias("seg")))).alias("segs"))
            .select("host", "typed", F.array_join(F.transform("segs", lambda x: x["seg"]), "/").alias("template")))


def judged_templates(paths: DataFrame, s: TreeSettings) -> DataFrame:
    """``host, template``, the branch it was merged into, its labelled counts, purity and verdict."""
    t = (paths.groupBy("host", "template")
         .agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "blocked")))
         .withColumn("shape", F.regexp_replace("template", r"[^/*]+", "w")))
    pool = t.groupBy("host", "shape").agg(F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
    share = F.try_divide("all_blocked", "all_labelled")
    error = F.sqrt(F.try_divide(share * (1 - share), F.col("labelled")))
    similar = F.abs(F.try_divide("blocked", "labelled") - share) <= s.z * error
    t = t.join(pool, ["host", "shape"]).withColumn("branch", F.when(similar, F.col("shape")).otherwise(F.col("template")))
    merged = t.groupBy("host", "branch").agg(F.sum("labelled").alias("branch_labelled"), F.sum("blocked").alias("branch_blocked"))
    base = t.agg((F.sum("blocked") / F.greatest(F.sum("labelled"), F.lit(1))).alias("base"))
    purity = (F.col("branch_blocked") + s.weight * F.col("base")) / (F.col("branch_labelled") + s.weight)
    return (t.join(merged, ["host", "branch"]).crossJoin(F.broadcast(base))  # one row
            .withColumn("purity", purity)
            .withColumn("template_verdict", F.when((F.col("branch_labelled") > 0) & (F.col("purity") >= s.reject), "block").otherwise("allow"))
            .select("host", "template", "branch", "branch_labelled", "branch_blocked", "purity", "template_verdict"))


def url_filter(pages: DataFrame, rules: list[Rule], settings: TreeSettings = TreeSettings()) -> DataFrame:
    """``page_id, url, host, path, rule, template, branch, purity, verdict`` for every row of ``pages``."""
    p = pages.select("page_id", F.col("url").cast("string").alias("url"))
    p = p.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    p = p.withColumns({"fit": rule_for(F.col("host"), F.col("path"), rules), "typed": typed(F.regexp_replace("path", "/+$", ""))})
    paths = p.groupBy("host", "typed").agg(
        F.count("*").alias("n"), F.count("fit").alias("labelled"),
        F.count(F.when(F.col("fit.verdict") == "block", True)).alias("blocked"))
    paths = paths.join(templates(paths, settings), ["host", "typed"])
    judged = paths.join(judged_templates(paths, settings), ["host", "template"]).drop("n", "labelled", "blocked")
    return p.join(judged, ["host", "typed"]).select(
        "page_id", "url", "host", "path", F.col("fit.name").alias("rule"), "template", "branch", "purity",
        F.coalesce("fit.verdict", "template_verdict").alias("verdict"))
