"""Mix sources to target weights by weighted fair queueing, with DataFrame operations alone.

Each source's documents queue in a shuffled order (md5 of doc_id and seed), up
to ``max_epochs`` times over.  A copy's virtual finish time is the tokens its
source has queued up to and with it, divided by the source's target: all
sources reach their targets at time 1.  All copies are sorted by finish time
over the whole corpus and cut where the running total passes the budget.

Targets share the budget (by default the size of all documents) by weight; a
source stops at ``max_epochs`` times its size, and what it leaves is shared
among the others by weight until none is above (water filling).

Order statistics and running sums are made by range partitions with offsets,
so a source with most of the rows is spread over many tasks; only scalars
(totals and the water level) reach the driver.

Defined results: a null or empty text has size 0 and is taken 0 words; null is
a source of its own, last in order; rows that repeat a ``doc_id`` are documents
of their own; ties in finish time go by source, round, shuffle key, doc_id, size
and a hash of the text; if all sizes are 0, all targets are 0; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.ordered import running_sums
from riskframe.session import Scratch, ensure_checkpoint_dir
from riskframe.sources.tables import read_table

SEED = 17
MAX_EPOCHS = 3
CYCLE = 3  # sources in order weigh 1, 2, 3, 1, 2, 3, ...
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f"-{seed}")).cast("binary"))


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS, cycle: int = CYCLE) -> DataFrame:
    """From (source, source_size): also target, and before (the sizes of all sources earlier in order)."""
    by_name = [F.col("source").asc_nulls_last()]
    named = running_sums(sizes, by_name, {"through": "source_size"}, row_number="rank")
    weighed = named.select("source", "source_size", (F.col("through") - F.col("source_size")).alias("before"),
                           ((F.col("rank") - 1) % cycle + 1).alias("weight"),
                           (max_epochs * F.col("source_size")).alias("cap"))
    # sources that reach their caps first come first
    filled = running_sums(weighed.withColumn("ratio", F.col("cap") / F.col("weight")), ["ratio", *by_name],
                          {"caps": "cap", "weights": "weight"}, row_number="place").checkpoint(eager=True)
    total = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if not total["size"]:
        return filled.select("source", "source_size", "before", F.lit(0.0).alias("target"))
    # the level if this source were the first that stays below its cap
    level = (F.lit(total["size"]) - F.col("caps") + F.col("cap")) / (F.lit(total["weight"]) - F.col("weights") + F.col("weight"))
    water = (filled.select("place", "ratio", level.alias("level")).where("level < ratio")
             .agg(F.min_by("level", "place").alias("level")).first()["level"])
    target = F.col("cap").cast("double") if water is None else F.least(F.col("cap").cast("double"), F.lit(water) * F.col("weight"))
    return filled.select("source", "source_size", "before", target.alias("target"))


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, cycle: int = CYCLE, seed: int = SEED, number: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, text_hash, size,
    source_size, target, copies (how often the mix takes it), taken (its words in the mix), and
    ``number``, a column that tells rows apart, if it's named."""
    ensure_checkpoint_dir(docs.sparkSession)
    sized = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size"),
                        shuffle_key(F.col("doc_id"), seed).alias("key"), *([number] if number else [])).checkpoint(eager=True)
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), max_epochs, cycle)
    sources = sources.checkpoint(eager=True)
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    order = [F.col("source").asc_nulls_last(), "key", "doc_id", "size", "text_hash"]
    queued = running_sums(sized, order, {"through": "size"}, row_number="place")
    by_source = sources.withColumnRenamed("source", "of")
    placed = queued.join(by_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    finish = F.when(F.col("target") > 0, ((F.col("round") - 1) * F.col("source_size") + F.col("through") - F.col("before"))
                    / F.col("target")).otherwise(F.lit(0.0))
    copies = placed.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(max_epochs)))).withColumn("finish", finish)
    served = running_sums(copies, ["finish", order[0], "round", "place"], {"total": "size"})
    columns = ["doc_id", "source", "text_hash", "size", "source_size", "target", *([number] if number else [])]
    kept = F.count_if(F.col("total") <= F.lit(budget))
    return (served.groupBy("place").agg(*[F.first(c).alias(c) for c in columns], kept.alias("copies"))
            .select(*columns, "copies", (F.col("size") * F.col("copies")).alias("taken")))


def apply_mix(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with each row as often as ``mix`` takes it (rows taken 0 times are gone); same columns."""
    # rows are numbered in a stored copy, so equal ones stay rows of their own, with all their columns
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = docs.select(row.alias("row"), F.monotonically_increasing_id().alias("number"))
    numbered = Scratch(docs.sparkSession, "mixing").write(numbered)
    parts = numbered.select("number", *[F.col("row").getField(c).alias(c) for c in ("doc_id", "text", "source")])
    taken = mix(parts, **how, number="number").where("copies > 0").select("number", "copies")
    each = numbered.join(taken, "number").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH sized AS (
  SELECT row_number() OVER () AS rid, doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || '-17') AS key,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
ratios AS (
  SELECT *, 3 * source_size AS cap, (3 * source_size) / CAST(weight AS DOUBLE) AS ratio FROM sources),
filled AS (
  SELECT *, row_number() OVER w AS place,
         ((SELECT sum(source_size) FROM sources) - sum(cap) OVER w + cap)
         / CAST((SELECT sum(weight) FROM sources) - sum(weight) OVER w + weight AS DOUBLE) AS level
  FROM ratios WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
water AS (SELECT min_by(level, place) AS level FROM filled WHERE level < ratio),
targets AS (
  SELECT source, source_size, weight, least(CAST(cap AS DOUBLE), coalesce(water.level * weight, CAST(cap AS DOUBLE))) AS target
  FROM filled, water),
queued AS (
  SELECT rid, doc_id, s.source, key, size, source_size, target,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS through
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, CASE WHEN target > 0 THEN ((round - 1) * source_size + through) / target ELSE 0.0 END AS finish
  FROM queued, (SELECT unnest([1, 2, 3]) AS round)),
served AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, round, key, doc_id, size ROWS UNBOUNDED PRECEDING)
            <= (SELECT sum(size) FROM sized) AS kept
  FROM copies)
SELECT any_value(doc_id) AS doc_id, CAST(any_value(size) AS BIGINT) AS size, any_value(source_size) AS source_size,
       any_value(target) AS target, CAST(any_value(size) * count(*) FILTER (WHERE kept) AS BIGINT) AS taken
FROM served GROUP BY rid
"""
