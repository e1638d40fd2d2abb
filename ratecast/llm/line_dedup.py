"""Line deduplication over overlapping three-line windows.

Every run of three consecutive lines is a window. A window that occurs more
than once keeps its first occurrence (smallest doc_id, then smallest line
number); the lines of all later occurrences are removed, overlapping windows
merging into one removed run. Windows are judged on the input, never on what
an earlier removal left.

Defined cases: a null text is an empty one; a text of fewer than three lines
has no window and stays as it is; windows of blank lines only are not looked
at; rows equal in doc_id and text are one document, each returned; columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecast.llm.common import join_by_key, keyed

WINDOW = 3


def line_windows(docs: DataFrame) -> DataFrame:
    """One row per window: its 128-bit hash, its document and the number of its first line."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.xxhash64(x))
    d = (docs.select("doc_id", "text_key", F.split("text", "\n").alias("lines"), lines.alias("h"))
         .where(F.size("lines") >= WINDOW))
    blank = F.xxhash64(F.lit(""))
    at = F.posexplode(F.expr(
        f"transform(sequence(0, size(h) - {WINDOW}), i -> struct(xxhash64(h[i], h[i+1], h[i+2]) as a,"
        " xxhash64('second', lines[i], lines[i+1], lines[i+2]) as b,"
        " h[i] = blank and h[i+1] = blank and h[i+2] = blank as empty))"))
    return (d.withColumn("blank", blank).select("doc_id", "text_key", at.alias("pos", "w"))
            .where(~F.col("w.empty")).select("doc_id", "text_key", "pos", "w.a", "w.b"))


def repeated_windows(windows: DataFrame) -> DataFrame:
    """Windows with more than one occurrence and the place of the first.

    The aggregate is combined before its shuffle, so a window that a third of
    all documents share reaches the reducer as one row per task.
    """
    place = F.struct("doc_id", "text_key", "pos")
    return (windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"))
            .where(F.col("first") != F.col("last")).select("a", "b", "first"))


def kept_lines(lines: str, starts: str) -> Column:
    """The lines outside the windows that begin at ``starts`` (ascending, at least one): those before the first, and those between each
    and the next."""
    after = F.transform(starts, lambda p, i: F.slice(
        lines, p + WINDOW + 1, F.greatest(F.lit(0), F.coalesce(F.get(starts, i + 1), F.size(lines)) - p - WINDOW)))
    return F.flatten(F.concat(F.array(F.slice(lines, F.lit(1), F.get(starts, F.lit(0)))), after))


def line_dedup(docs: DataFrame, *carry: str) -> DataFrame:
    """``doc_id, text_key, text`` (what is left), ``n_lines``, ``n_removed`` and the carried columns per document."""
    docs = keyed(docs, *carry)
    windows = line_windows(docs)
    w, r = windows.alias("w"), repeated_windows(windows).alias("r")
    later = (w.join(r, (F.col("w.a") == F.col("r.a")) & (F.col("w.b") == F.col("r.b")))
             .where(F.struct("w.doc_id", "w.text_key", "w.pos") != F.col("r.first"))
             .groupBy("w.doc_id", "w.text_key").agg(F.collect_set("w.pos").alias("starts")))
    cut = (join_by_key(docs, later, "left")
           .select("doc_id", "text_key", "text", F.split("text", "\n").alias("lines"), F.array_sort("starts").alias("starts"), *carry)
           .withColumn("kept", F.when(F.col("starts").isNotNull(), kept_lines("lines", "starts"))))
    return cut.select("doc_id", "text_key", F.coalesce(F.array_join("kept", "\n"), "text").alias("text"), F.size("lines").alias("n_lines"),
                      F.when(F.col("kept").isNull(), 0).otherwise(F.size("lines") - F.size("kept")).alias("n_removed"), *carry)


#: The same result in DuckDB, on the lines themselves.
SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM d),
w AS (SELECT DISTINCT doc_id, text, unnest(range(0, len(ls) - 2)) AS pos, ls FROM l WHERE len(ls) >= 3),
k AS (SELECT doc_id, text, pos, ls[pos + 1] AS x, ls[pos + 2] AS y, ls[pos + 3] AS z FROM w),
o AS (SELECT doc_id, text, pos, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, text, pos) AS rn
      FROM k WHERE x <> '' OR y <> '' OR z <> ''),
g AS (SELECT DISTINCT doc_id, text, pos + unnest([0, 1, 2]) AS pos FROM o WHERE rn > 1),
gone AS (SELECT doc_id, text, list(pos) AS gs FROM g GROUP BY doc_id, text)
SELECT l.doc_id, len(ls)::INT AS n_lines, coalesce(len(gs), 0)::INT AS n_removed,
       array_to_string(list_filter(ls, lambda s, i: NOT list_contains(coalesce(gs, []::BIGINT[]), i - 1)), chr(10)) AS text
FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.text = gone.text
"""
