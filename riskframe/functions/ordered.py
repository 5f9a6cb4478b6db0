"""Global order over a table of any size: range partitions plus partition offsets.

A global rank or running sum needs no single-task window: rows are range
partitioned on the order columns, each partition is numbered on its own, and
the totals of the earlier partitions (one row per partition) are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir

PART = "_part"


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_split(df: DataFrame, order: list[str | Column], partitions: int | None = None) -> DataFrame:
    """``df`` in range partitions of ``order``, with the partition number in ``_part``.

    The copy is checkpointed, so the partition of a row is a stored fact: a
    recomputed task can't deal rows out differently.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or shuffle_partitions(df)
    return df.repartitionByRange(n, *order).withColumn(PART, F.spark_partition_id()).checkpoint(eager=True)


def running_sums(df: DataFrame, order: list[str | Column], sums: dict[str, str],
                 row_number: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add inclusive running sums over the whole table in ``order``.

    ``sums`` maps a new column to the (non-null, integral) column it sums;
    ``row_number`` names a column for the row's 1-based global position.
    ``order`` should be unique per row, or ties are numbered arbitrarily.
    """
    split = range_split(df, order, partitions)
    totals = split.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{k}") for k, c in sums.items()])
    # one row per partition, so this window and the broadcast are bounded by the partition count
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o_n"),
                            *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
    within = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = split.join(F.broadcast(offsets), PART).withColumns(
        {k: F.col(f"_o_{k}") + F.sum(c).over(within) for k, c in sums.items()}
        | ({row_number: F.col("_o_n") + F.row_number().over(Window.partitionBy(PART).orderBy(*order))} if row_number else {}))
    return out.drop(PART, "_o_n", *[f"_o_{k}" for k in sums])
