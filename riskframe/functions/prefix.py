"""Exact running sums within groups, without a window over a whole group.

``sum(x) over (partition by g order by v)`` puts every row of a group in one
task; for a group holding most of the data (one drift column, one score
column) that is the whole table.  ``running_totals`` range-partitions the rows
on (group columns, value) instead, whatever the size and type of the table:

1. a large group is cut into several ranges of its real values, so it spans
   several partitions; the copy is checkpointed with its partition number;
2. per (group, partition) totals are at most groups + partitions rows; an
   ordered window over them gives the exact offset of every range and the
   first value of the next one;
3. a window within (group, partition) adds the local running sum.

The result is exact and doesn't depend on where the ranges are cut.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.ordered import PART, range_split


def running_totals(df: DataFrame, group_cols: list[str], order_col: str, sum_cols: list[str],
                   next_col: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum of ``c`` within the group, in
    ``order_col`` order) and, if ``next_col`` is given, the next larger
    ``order_col`` value of the group (NULL for the last row).

    Rows must be unique on (group columns, order column): aggregate first.
    NULL group values are a group; a NULL order value comes first.
    """
    keys = list(group_cols)
    split = range_split(df, [*keys, order_col], partitions)
    totals = split.groupBy(*keys, PART).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols], F.min(order_col).alias("_first"))
    ranges = Window.partitionBy(*keys).orderBy(PART)
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(PART).alias("_k_part"),
                            *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
                            F.lead("_first").over(ranges).alias("_next"))
    match = reduce(lambda a, k: a & F.col(k).eqNullSafe(F.col(f"_k_{k}")), keys, F.col(PART) == F.col("_k_part"))
    within = Window.partitionBy(*keys, PART).orderBy(order_col)
    out = split.join(offsets, match).withColumns(
        {f"cum_{c}": F.col(f"_o_{c}") + F.sum(c).over(within.rowsBetween(Window.unboundedPreceding, 0)) for c in sum_cols})
    if next_col:
        out = out.withColumn(next_col, F.coalesce(F.lead(order_col).over(within), F.col("_next")))
    return out.select(*df.columns, *[f"cum_{c}" for c in sum_cols], *([next_col] if next_col else []))
