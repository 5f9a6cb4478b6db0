"""Drift of a model's scores over time, from mergeable sketches per day.

Each day is one row: rows, labels, score sum and a KLL quantile sketch of the
scores, all of which merge.  Longer windows are merged from the days, so a new
day is added without reading old scores, and a window costs days, not rows.

A window is compared with a reference window at the reference's quantiles: the
largest difference of the two distribution functions there.  From
``DISTANCE_THRESHOLD`` on that is drift; the mean score stands beside the
share of positives, which it should follow.

Sketches of up to ``SKETCH_K`` scores are exact; beyond that a rank is off by
about 1 / SKETCH_K of the window's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.drift import DISTANCE_THRESHOLD
from riskframe.operators.features import LABEL
from riskframe.session import ensure_checkpoint_dir

SKETCH_K = 4096
QUANTILES = [0.25, 0.5, 0.75, 0.95]
GRID = [i / 20 for i in range(1, 20)]  # of the reference, where distributions are compared
SUMS = ("n_rows", "n_pos", "score_sum")


def daily_scores(scored: DataFrame, ts: str = "trans_date_trans_time", score: str = "fraud_score", label: str = LABEL,
                 k: int = SKETCH_K) -> DataFrame:
    """(day, n_rows, n_pos, score_sum, sketch); rows without a day or a score don't count, a missing label is no positive."""
    rows = scored.where(F.col(ts).isNotNull() & F.col(score).isNotNull())
    return rows.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(label) == 1).alias("n_pos"), F.sum(F.col(score).cast("double")).alias("score_sum"),
        F.kll_sketch_agg_double(F.col(score).cast("double"), F.lit(k)).alias("sketch"))


def merged(daily: DataFrame, window: str = "month") -> DataFrame:
    """The same for the calendar windows ('week', 'month', 'quarter', 'year') of a table of days or shorter windows."""
    day = "day" if "day" in daily.columns else "window"
    return daily.groupBy(F.trunc(day, window).alias("window")).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.kll_merge_agg_double("sketch").alias("sketch"))


def score_drift(windows: DataFrame, reference: str | None = None, threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    """Per window: rows, positives, sum and mean of the scores, quantiles, distance from the ``reference`` window (its date, else the
    earliest) and whether that is drift."""
    ensure_checkpoint_dir(windows.sparkSession)
    windows = windows.checkpoint(eager=True)  # a row a window
    chosen = windows if reference is None else windows.where(F.col("window") == F.lit(reference).cast("date"))
    at = lambda q: F.kll_sketch_get_quantile_double("sketch", F.lit(q))
    below = lambda x: F.kll_sketch_get_rank_double("sketch", F.lit(x))
    row = chosen.orderBy("window").select(*[at(q).alias(f"x{i}") for i, q in enumerate(GRID)], "sketch").limit(1)
    points = row.first()
    if points is None:
        if reference is not None and not windows.isEmpty():
            raise ValueError(f"no window {reference}")
        points = [0.0] * len(GRID)
    grid = [float(x) for x in points[:len(GRID)]]
    base = row.select(*[below(x).alias(f"r{i}") for i, x in enumerate(grid)]).first() or [0.0] * len(grid)
    gaps = [F.abs(below(x) - F.lit(float(r))) for x, r in zip(grid, base)]
    return windows.select("window", *SUMS, (F.col("score_sum") / F.col("n_rows")).alias("mean_score"),
                          (F.col("n_pos") / F.col("n_rows")).alias("pos_rate"),
                          *[at(q).alias(f"p{round(100 * q)}") for q in QUANTILES], F.greatest(*gaps).alias("distance")).withColumn(
        "drift", F.col("distance") >= F.lit(float(threshold)))
