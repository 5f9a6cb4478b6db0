"""Exploration and data-quality aggregates (class balance, rates, box stats,
histograms, cardinality, value previews, value pools).

Each is one or two aggregations with map-side combine; results are small
(one row per class / group / bin / column) and stay DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.joins import sized_broadcast
from riskframe.functions.prefix import running_totals
from riskframe.operators.features import LABEL
from riskframe.session import ensure_checkpoint_dir

Z_95 = 1.959963984540054  # two-sided 95 % normal quantile


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def value_frequencies(df: DataFrame, col: str) -> DataFrame:
    """``value_counts(normalize=True)``: share of rows per value."""
    # one pass: the grouped counts are materialised and their sum is the total
    ensure_checkpoint_dir(df.sparkSession)
    g = df.groupBy(col).agg(F.count("*").alias("n")).checkpoint(eager=True)
    total = g.agg(F.sum("n")).first()[0] or 0
    return g.withColumn("freq", F.col("n") / F.lit(total))


def positive_rate(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows, positives and positive rate in one pass."""
    y = F.col(label)
    return df.agg(F.count("*").alias("n_rows"), F.sum(y).cast("long").alias("n_pos"),
                  F.avg(y.cast("double")).alias("pos_rate"))


def require_positives(df: DataFrame, label: str = LABEL, minimum: int = 2) -> int:
    n = df.select(F.sum(F.col(label)).cast("long")).first()[0] or 0
    if n < minimum:
        raise ValueError(f"Not enough positive examples ({n} < {minimum}).")
    return n


def rate_by_group(df: DataFrame, group: str, label: str = LABEL) -> DataFrame:
    """Positive rate per group, highest first."""
    return (df.groupBy(group).agg(F.avg(F.col(label).cast("double")).alias("fraud_rate"),
                                  F.count("*").alias("n"))
            .orderBy(F.desc("fraud_rate"), group))


def daily_counts(df: DataFrame, ts: str = "trans_date_trans_time", label: str = LABEL) -> DataFrame:
    """Positives per calendar day with empty days present as 0 (daily resample)."""
    day = F.to_date(F.col(ts))
    daily = df.groupBy(day.alias("day")).agg(F.sum(F.col(label)).cast("long").alias("n_pos"),
                                              F.count("*").alias("n_rows"))
    return fill_days(daily)


def fill_days(daily: DataFrame) -> DataFrame:
    """(day, n_pos, n_rows) with every day from the first to the last, those without rows as 0."""
    # one row per day: materialised once, read by the span and the join
    ensure_checkpoint_dir(daily.sparkSession)
    daily = daily.checkpoint(eager=True)
    span = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    cal = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    # one row per day on both sides
    return (cal.join(sized_broadcast(daily), "day", "left")
            .select("day", F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
                    F.coalesce("n_rows", F.lit(0)).alias("n_rows")))


def value_counts_by_group(df: DataFrame, value: str, group: str) -> DataFrame:
    """``(group, value, c)`` for non-null values, materialised once."""
    vc = df.groupBy(group, value).agg(F.count("*").alias("c")).where(F.col(value).isNotNull())
    ensure_checkpoint_dir(df.sparkSession)
    return vc.checkpoint(eager=True)


def exact_quantiles(df: DataFrame | None, value: str, group: str, probs: list[float],
                    vc: DataFrame | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group, without holding a
    group's values in one task: count per (group, value), exact running
    counts (``running_totals``), then pick the two ranks around
    ``(n-1)*q`` by an equi-join on the group plus a range predicate."""
    vc = vc if vc is not None else value_counts_by_group(df, value, group)
    rt = running_totals(vc, [group], value, ["c"])
    ntot = vc.groupBy(group).agg(F.sum("c").alias("_n"))
    qs = F.array(*[F.lit(float(p)) for p in probs])
    tgt = (ntot.select(group, "_n", F.posexplode(qs).alias("qi", "q"))
           .withColumn("_h", (F.col("_n") - 1) * F.col("q"))
           .withColumn("_lo", F.floor("_h")).withColumn("_hi", F.ceil("_h")))
    tgt = tgt.select(group, "qi", "q", "_h", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("_lo").alias("r")),
        F.struct(F.lit(1).alias("side"), F.col("_hi").alias("r")))).alias("t"))
    tgt = tgt.select(group, "qi", "q", "_h", "t.side", "t.r")
    # rank r (0-based) is held by the value whose [cum - c, cum - 1] covers it
    hit = rt.join(sized_broadcast(tgt), group).where(
        (F.col("r") >= F.col("cum_c") - F.col("c")) & (F.col("r") <= F.col("cum_c") - 1))
    piv = hit.groupBy(group, "qi", "q", "_h").agg(
        F.max(F.when(F.col("side") == 0, F.col(value))).alias("_vlo"),
        F.max(F.when(F.col("side") == 1, F.col(value))).alias("_vhi"))
    frac = F.col("_h") - F.floor("_h")
    return piv.select(group, "qi", "q", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac)
                      .cast("double").alias("quantile"))


def box_stats(df: DataFrame, value: str = "amt", group: str = "category", exact: bool = True,
              accuracy: int = 10000) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme points inside) and outlier count."""
    # every statistic below reads the per-(group, value) counts: one pass over the rows
    vc = value_counts_by_group(df, value, group)
    if exact:
        q = exact_quantiles(None, value, group, [0.25, 0.5, 0.75], vc=vc)
        qs = q.groupBy(group).agg(
            F.max(F.when(F.col("qi") == 0, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("qi") == 1, F.col("quantile"))).alias("median"),
            F.max(F.when(F.col("qi") == 2, F.col("quantile"))).alias("q3"))
    else:
        p = F.percentile_approx(F.col(value).cast("double"), [0.25, 0.5, 0.75], accuracy)
        qs = df.groupBy(group).agg(p.alias("_p")).select(
            group, F.col("_p")[0].alias("q1"), F.col("_p")[1].alias("median"), F.col("_p")[2].alias("q3"))
    qs = sized_broadcast(qs.withColumn("iqr", F.col("q3") - F.col("q1")))  # one row per group
    v = F.col(value)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    j = vc.join(qs, group)
    agg = j.groupBy(group).agg(
        F.sum("c").alias("n"),
        F.min(F.when(v >= lo_f, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi_f, v)).alias("whisker_hi"),
        F.sum(F.when((v < lo_f) | (v > hi_f), F.col("c")).otherwise(0)).cast("long").alias("n_outliers"))
    return agg.join(qs, group).select(group, F.col("n").cast("long").alias("n"), "q1", "median", "q3", "iqr",
                                      "whisker_lo", "whisker_hi", "n_outliers")


def class_histogram(df: DataFrame, value: str = "age", label: str = LABEL, bins: int = 40) -> DataFrame:
    """Per-class density histogram on common equal-width bins (min..max of all
    rows; last bin closed). density = count / (class rows * bin width)."""
    v = F.col(value).cast("double")
    # range of all rows: one small aggregate, two numbers on the driver
    r = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    if r["lo"] is None:
        return df.sparkSession.createDataFrame([], f"{label} {dict(df.dtypes)[label]}, bin int, bin_lo double, "
                                                   "bin_hi double, n long, density double")
    lo, hi = F.lit(float(r["lo"])), F.lit(float(r["hi"]))
    width = (hi - lo) / F.lit(float(bins))
    b = F.least(F.floor((v - lo) / width), F.lit(bins - 1)).cast("int")
    b = F.when(hi == lo, F.lit(0)).otherwise(b)
    h = (df.where(F.col(value).isNotNull())
         .groupBy(label, b.alias("bin")).agg(F.count("*").alias("n")))
    # class sizes from the (small) histogram itself: no extra pass over the rows
    ensure_checkpoint_dir(df.sparkSession)
    h = h.checkpoint(eager=True)
    ncls = h.groupBy(label).agg(F.sum("n").alias("n_class"))
    h = h.join(sized_broadcast(ncls), label)
    w = F.when(hi == lo, F.lit(1.0)).otherwise((hi - lo) / F.lit(float(bins)))
    return h.select(label, "bin",
                    (lo + F.col("bin") * w).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * w).alias("bin_hi"),
                    "n", (F.col("n") / (F.col("n_class") * w)).alias("density"))


def rate_with_interval(df: DataFrame, group: str = "gender", label: str = LABEL) -> DataFrame:
    """Mean label per group with a normal 95 % interval."""
    y = F.col(label).cast("double")
    a = df.groupBy(group).agg(F.count(y).alias("n"), F.avg(y).alias("rate"), F.stddev_samp(y).alias("sd"))
    half = F.lit(Z_95) * F.coalesce(F.col("sd"), F.lit(0.0)) / F.sqrt(F.col("n").cast("double"))
    return a.select(group, "n", "rate", (F.col("rate") - half).alias("ci_lo"), (F.col("rate") + half).alias("ci_hi"))


def cardinality(df: DataFrame, approx: bool = False, high: int = 100) -> DataFrame:
    """Distinct non-null values of every column in one job; flags text columns
    above ``high`` distinct values."""
    types = dict(df.dtypes)
    cnt = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    wide = df.agg(*[cnt(F.col(f"`{c}`")).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column_name", "n_distinct")
    tmap = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return long.select("column_name", F.col("n_distinct").cast("long").alias("n_distinct"),
                       tmap[F.col("column_name")].alias("dtype")).withColumn(
        "high_cardinality", (F.col("dtype") == "string") & (F.col("n_distinct") > high))


def high_cardinality(df: DataFrame, high: int = 100, rsd: float = 0.02) -> DataFrame:
    """(column_name, n_distinct, exact, high_cardinality) of every column: whether it has more than ``high`` distinct
    values, exactly, from sketches.

    One pass makes a HyperLogLog sketch per column; only columns whose estimate is within ten standard errors of the
    limit are counted exactly, by distinct (column, value) pairs.  ``n_distinct`` is that count, else the estimate."""
    names = df.columns
    schema = "column_name string, n_distinct long, exact boolean, high_cardinality boolean"
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    wide = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), rsd).alias(f"c{i}") for i, c in enumerate(names)]).first()
    found = dict(zip(names, wide))
    near = [c for c in names if high * (1 - 10 * rsd) <= found[c] <= high * (1 + 10 * rsd)]
    exact: dict[str, int] = {}
    if near:
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
                                              for c in near])).alias("x")).select("x.*").where(F.col("value").isNotNull())
        exact = {r["column_name"]: r["count"] for r in pairs.distinct().groupBy("column_name").count().collect()}  # a row a column
    counts = {c: exact.get(c, 0) if c in near else found[c] for c in names}
    return df.sparkSession.createDataFrame([(c, n, c in near, n > high) for c, n in counts.items()], schema)


def type_census(df: DataFrame) -> DataFrame:
    """Columns per data type (schema metadata only)."""
    spark = df.sparkSession
    rows = {}
    for _, t in df.dtypes:
        rows[t] = rows.get(t, 0) + 1
    return spark.createDataFrame(sorted(rows.items()), "dtype string, n_columns long")


def _least_distinct(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[str, pa.Array] = {}
    for batch in batches:
        for name, column in zip(batch.schema.names, batch.columns):
            values = pa.concat_arrays([kept[name], column]) if name in kept else column
            values = values.drop_null().unique()
            # bytes sort as Spark sorts strings
            order = pc.array_sort_indices(values.cast(pa.binary()))
            kept[name] = values.take(order[:k])
    for name, values in kept.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), values], names=["column_name", "value"])


def value_preview(df: DataFrame, cols: list[str] | None = None, k: int = 5) -> DataFrame:
    """First ``k`` distinct values (in sort order) of each text column.

    A task keeps the k least distinct values of each column that it meets, so it hands on at most k rows a column,
    however many values there are and however often one occurs."""
    cols = cols or [c for c, t in df.dtypes if t == "string"]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, pos int, value string")
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    least = text.mapInArrow(partial(_least_distinct, k), "column_name string, value string").distinct()
    w = Window.partitionBy("column_name").orderBy("value")
    return least.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= k).select("column_name", "pos", "value")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of one column (a value pool)."""
    return df.select(col).dropna().distinct()


def distinct_tuples(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct complete tuples of several columns."""
    return df.select(*cols).dropna().dropDuplicates(cols)
