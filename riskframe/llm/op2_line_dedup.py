"""Cross-site boilerplate lines out of documents, with DataFrame operations alone.

A line's spread is the number of distinct sites (``source``) it's seen on.
HyperLogLog sketches of the sites are built per line hash and merged by the
aggregation, so a line that stands in a third of all rows costs one sketch a
task.  Lines whose estimate is well above ``min_sites`` are boilerplate, those
well below are not; lines in between get an exact distinct count.  Every copy
of a boilerplate line is then removed from every document.

Lines are compared without spaces, tabs and carriage returns around them, by
two independent 64-bit hashes.

Defined results: blank lines are never removed and not counted; a null text
has no lines and stays null; an empty text is one blank line; a null source is
a site of its own; rows that repeat a ``doc_id`` are cleaned one by one;
texts that lose all lines become empty; an empty table gives no rows.  Other
columns are not read, or passed on as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.tables import read_table

MIN_SITES = 5
LOG_K = 12  # a sketch of 2^12 registers: a standard error of 1.6 %
MARGIN = 0.25  # estimates this near the threshold are counted exactly
_BREAK = "\n"


def line_key(line: Column) -> list[Column]:
    bare = F.btrim(line, F.lit(" \t\r"))
    return [F.xxhash64(bare).alias("h1"), F.xxhash64(F.lit(1), bare).alias("h2")]


def _lines(docs: DataFrame) -> DataFrame:
    """The lines that aren't blank: doc, text_hash, site, at, h1, h2."""
    site = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-"))
    lines = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("text_hash"), site.alias("site"),
                        F.posexplode(F.split("text", _BREAK)).alias("at", "line"))
    return lines.where(F.btrim("line", F.lit(" \t\r")) != "").select("doc", "text_hash", "site", "at", *line_key(F.col("line")))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """Keys (h1, h2) of lines seen on ``min_sites`` sites or more."""
    ensure_checkpoint_dir(docs.sparkSession)
    lines = _lines(docs)
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_K)).alias("sites"))
    likely = spread.where(F.col("sites") >= min_sites * (1 - margin)).checkpoint(eager=True)
    near = likely.where(F.col("sites") <= min_sites * (1 + margin)).select("h1", "h2")
    counted = (lines.select("h1", "h2", "site").join(near, ["h1", "h2"], "left_semi").distinct()
               .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites))
    sure = likely.where(F.col("sites") > min_sites * (1 + margin)).select("h1", "h2")
    return sure.union(counted.select("h1", "h2")).checkpoint(eager=True)


def clean_lines(docs: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text``, and n_lines and n_removed added."""
    common = boilerplate(docs, min_sites, margin)
    removed = (_lines(docs).join(common, ["h1", "h2"], "left_semi")
               .groupBy("doc", "text_hash").agg(F.collect_set("at").alias("removed")))
    names = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").alias("body"),
                       F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    joined = rows.join(removed, F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("text_hash")), "left")
    lines = F.split("body", _BREAK)
    left = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed")))
    text = F.when(F.col("removed").isNull(), F.col("body")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), _BREAK))
    return joined.select(*[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns],
                         F.when(F.col("body").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                         F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed")).cast("long").alias("n_removed"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return clean_lines(docs).select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


ORACLE = r"""
WITH lines AS (
  SELECT rid, doc_id, source, i, all_lines[i] AS line, trim(all_lines[i], ' ' || chr(9) || chr(13)) AS bare
  FROM (SELECT row_number() OVER () AS rid, doc_id, source, string_split(text, chr(10)) AS all_lines FROM documents),
       LATERAL (SELECT unnest(range(1, len(all_lines) + 1)) AS i)),
common AS (
  SELECT bare FROM lines WHERE bare <> '' GROUP BY bare
  HAVING count(DISTINCT coalesce('+' || source, '-')) >= 5),
marked AS (SELECT l.*, c.bare IS NOT NULL AS gone FROM lines l LEFT JOIN common c ON l.bare = c.bare),
cleaned AS (
  SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS text_md5
  FROM marked GROUP BY rid)
SELECT doc_id, n_lines, n_removed, text_md5 FROM cleaned
UNION ALL
SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
