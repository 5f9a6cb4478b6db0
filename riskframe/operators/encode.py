"""Supervised (target) encoding of categorical columns.

Fit: one ``unpivot`` of the categorical columns to (feature, value) and one
``groupBy(feature, value)``: partial aggregation runs before the shuffle, so a
hot value (``gender`` has two) costs one row per map task, not a hot task.
Apply: one left join per column against that column's table, broadcast only
when the table is under the row bound, a shuffle join (AQE skew splitting)
beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.joins import broadcast_limit, measured
from riskframe.operators.features import CATEGORICAL_COLUMNS, LABEL
from riskframe.session import ensure_checkpoint_dir

# Encoder defaults (samples before the weight reaches 1/2, and slope).
MIN_SAMPLES_LEAF = 20
SMOOTHING = 10.0


def sigmoid_weight(n, min_samples_leaf: float = MIN_SAMPLES_LEAF, smoothing: float = SMOOTHING):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(float(min_samples_leaf))) / F.lit(float(smoothing))))


def fit_target_encoder(df: DataFrame, cols: list[str] | None = None, label: str = LABEL,
                       min_samples_leaf: float = MIN_SAMPLES_LEAF, smoothing: float = SMOOTHING,
                       method: str = "sigmoid", materialize: bool = True) -> DataFrame:
    """Fitted encoder table ``(feature, value, n, mean, enc, prior)``.

    ``enc = prior*(1-w) + mean*w`` with ``w = 1/(1+exp(-(n-min_samples_leaf)/smoothing))``;
    ``method='additive'`` uses ``w = n/(n+smoothing)`` instead.  NULL values do
    not form a category: they (like unseen values) map to the prior on apply.
    """
    cols = cols or CATEGORICAL_COLUMNS
    df = df.where(F.col(label).isNotNull())  # unlabelled rows carry no target information
    long = df.select(label, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [label], cols, "feature", "value")
    # one aggregation; NULL values are kept here only so that any one column's
    # groups cover every row, which gives the prior without a second scan
    allstats = long.groupBy("feature", "value").agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("double")).alias("_s"))
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        allstats = allstats.checkpoint(eager=True)
    prior = allstats.where(F.col("feature") == cols[0]).select((F.sum("_s") / F.sum("n")).alias("prior"))
    stats = allstats.where(F.col("value").isNotNull()).select(
        "feature", "value", "n", (F.col("_s") / F.col("n")).alias("mean"))
    # prior is a one-row aggregate of the small table, attached as an uncorrelated scalar subquery
    stats = stats.withColumn("prior", prior.scalar())
    n = F.col("n").cast("double")
    if method == "additive":
        w = n / (n + F.lit(float(smoothing)))
    else:
        w = sigmoid_weight(n, min_samples_leaf, smoothing)
    fitted = stats.withColumn("enc", F.col("prior") * (F.lit(1.0) - w) + F.col("mean") * w)
    if materialize:
        # fitting is an action, like any estimator: the small table is written
        # once to the shared checkpoint folder and reused by every apply
        fitted = fitted.checkpoint(eager=True)
    return fitted


def encoder_prior(encoder: DataFrame) -> DataFrame:
    return encoder.select(F.max("prior").alias("prior"))


def apply_target_encoder(df: DataFrame, encoder: DataFrame, cols: list[str] | None = None,
                         prior: float | None = None) -> DataFrame:
    """Replace each categorical column by its encoding; unseen/NULL -> prior."""
    cols = cols or CATEGORICAL_COLUMNS
    if prior is None:
        prior = encoder_prior(encoder).first()["prior"]  # one number
    prior_col = F.lit(float(prior)) if prior is not None else F.lit(None).cast("double")
    # one size check for the whole table: if it fits, every per-column slice does
    stored, size = measured(encoder.where(F.col("feature").isin(*cols)))
    small = size <= broadcast_limit(df)
    out = df
    for c in cols:
        m = stored.where(F.col("feature") == c).select(F.col("value").alias(f"_v_{c}"), F.col("enc").alias(f"_e_{c}"))
        m = F.broadcast(m) if small else m
        out = out.join(m, out[c].cast("string") == F.col(f"_v_{c}"), "left")
        out = out.withColumn(c, F.coalesce(F.col(f"_e_{c}"), prior_col)).drop(f"_v_{c}", f"_e_{c}")
    return out
