"""Join helpers: broadcast only behind a measured size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir


def broadcast_limit(df: DataFrame) -> int:
    """Bytes below which the planner itself broadcasts (``spark.sql.autoBroadcastJoinThreshold``)."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 8 a column, and the text of those of varying length."""
    sized = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c, t in df.dtypes
             if t in ("string", "binary") or t.startswith(("array", "map", "struct"))]
    return reduce(lambda a, b: a + b, sized, F.lit(8 * len(df.columns))).cast("long")


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """(``df`` checkpointed in the shared folder, its size in bytes)."""
    ensure_checkpoint_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    return stored, stored.agg(F.sum(_row_bytes(stored))).first()[0] or 0


def sized_broadcast(df: DataFrame) -> DataFrame:
    """``df`` computed once, and marked for broadcast if its measured bytes are below the planner's limit.

    Beyond it the join is left to the planner (sort-merge, with AQE's skew
    splitting).  The copy keeps the partitions of ``df``: nothing is gathered.
    """
    stored, size = measured(df)
    return F.broadcast(stored) if size <= broadcast_limit(df) else stored
