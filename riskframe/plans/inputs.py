"""Derived inputs shared by several registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heuristic_predictions(tx: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """A pre-computed prediction table ``(trans_num, y_true, y_pred_proba,
    y_pred_binary)`` from a fixed logistic rule on amount and priority.

    It stands in for scores produced elsewhere (the production validation
    path takes such a table, no model).
    """
    z = (F.log1p("amt") - F.lit(12.5)) * F.lit(3.0)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) * F.when(F.col("category") == "1-URGENT", 1.0).otherwise(0.5)
    p = F.round(p, 6)
    return tx.select("trans_num", F.col("is_fraud").alias("y_true"), p.alias("y_pred_proba"), *(keep or [])).withColumn(
        "y_pred_binary", (F.col("y_pred_proba") >= 0.5).cast("int"))


def year_halves(tx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reference = even transaction years, current = odd years (mild drift pair)."""
    y = F.year("trans_date_trans_time")
    return tx.where(y % 2 == 0), tx.where(y % 2 == 1)
