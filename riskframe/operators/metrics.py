"""Classification metrics on a (label, prediction, score) table.

The confusion table is one ``groupBy(y, pred)``; every report number is
algebra on that tiny table.  ROC AUC is exact (ties count 1/2): positives
and negatives per distinct score, then exact running negative counts from
``running_totals`` (range-split, no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.prefix import running_totals
from riskframe.session import ensure_checkpoint_dir

# Fixed value: AUC reference point the fine-tune reply compares against.
BASELINE_AUC = 0.74


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def per_class_metrics(df: DataFrame, y: str = "y_true", pred: str = "y_pred_binary") -> DataFrame:
    """Rows ``(label, precision, recall, f1, support)``, one per class seen in
    either column; ill-defined ratios are 0 (sklearn ``zero_division`` default)."""
    # rows without a label or a prediction are not scored
    conf = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull()).groupBy(
        F.col(y).alias("_y"), F.col(pred).alias("_p")).agg(F.count("*").alias("c"))
    # each confusion cell counts once for its true class and once for its predicted class
    roles = F.explode(F.array(
        F.struct(F.col("_y").alias("cls"), F.col("c").alias("support"),
                 F.when(F.col("_y") == F.col("_p"), F.col("c")).otherwise(F.lit(0)).alias("tp"),
                 F.lit(0).cast("long").alias("n_pred")),
        F.struct(F.col("_p").alias("cls"), F.lit(0).cast("long").alias("support"), F.lit(0).cast("long").alias("tp"),
                 F.col("c").alias("n_pred"))))
    per = conf.select(roles.alias("r")).select("r.*").groupBy("cls").agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("n_pred").alias("n_pred"))
    prec = _safe_div(F.col("tp"), F.col("n_pred"))
    rec = _safe_div(F.col("tp"), F.col("support"))
    per = per.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return per.withColumn("f1", f1).select(
        F.col("cls").cast("string").alias("label"), "precision", "recall", "f1",
        F.col("support").cast("long").alias("support"), F.col("tp").cast("long").alias("tp"))


def classification_report(df: DataFrame, y: str = "y_true", pred: str = "y_pred_binary") -> DataFrame:
    """Per-class rows plus 'accuracy', 'macro avg', 'weighted avg' rows.

    The accuracy row carries the accuracy in ``f1`` (precision/recall NULL)
    and the total in ``support``, as in the text report.
    """
    # one row per class, read twice below: materialised once (no cache left behind)
    ensure_checkpoint_dir(df.sparkSession)
    per = per_class_metrics(df, y, pred).checkpoint(eager=True)
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count("*").alias("k"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    n = F.col("n").cast("double")
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), _safe_div(F.col("tp"), F.col("n")).alias("f1"),
                     F.col("n").cast("long").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").cast("long").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"), (F.col("wp") / n).alias("precision"),
                          (F.col("wr") / n).alias("recall"), (F.col("wf") / n).alias("f1"),
                          F.col("n").cast("long").alias("support"))
    return per.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)


def roc_auc(df: DataFrame, y: str = "y_true", score: str = "y_pred_proba") -> DataFrame:
    """One row ``(roc_auc, n_pos, n_neg)``; AUC is NULL when a class is absent."""
    s = df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("long").alias("neg"))
    rt = running_totals(s, [], "s", ["neg"])
    # negatives strictly below a score plus half of the tied ones
    part = rt.agg(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))).alias("u"),
                  F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    auc = F.when((F.col("n_pos") == 0) | (F.col("n_neg") == 0), F.lit(None).cast("double")).otherwise(
        F.col("u") / (F.col("n_pos").cast("double") * F.col("n_neg").cast("double")))
    return part.select(auc.alias("roc_auc"), F.col("n_pos").cast("long").alias("n_pos"),
                       F.col("n_neg").cast("long").alias("n_neg"))


def staged_auc(df: DataFrame, stages: str, y: str = "y_true", partitions: int | None = None) -> DataFrame:
    """(stage, roc_auc, n_pos, n_neg) for each place of an array column of scores, from 1 on: the exact AUC of
    all stages from one running sum grouped by stage, in so many ``partitions``.  Rows without a label don't count."""
    rows = df.where(F.col(y).isNotNull()).select(F.col(y).alias("y"), F.posexplode(stages).alias("stage", "s"))
    ones = F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).cast("long")
    counts = rows.where(F.col("s").isNotNull()).groupBy((F.col("stage") + 1).alias("stage"), F.col("s").cast("double").alias("s")).agg(
        ones.alias("pos"), (F.count(F.lit(1)) - ones).alias("neg"))
    rt = running_totals(counts, ["stage"], "s", ["neg"], partitions=partitions)
    part = rt.groupBy("stage").agg(F.sum(F.col("pos") * (F.col("cum_neg") - 0.5 * F.col("neg"))).alias("u"),
                                   F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return part.select("stage", F.when(pairs > 0, F.col("u") / pairs).alias("roc_auc"), "n_pos", "n_neg")


def evaluate_predictions(df: DataFrame, y: str = "y_true", score: str = "y_pred_proba",
                         pred: str = "y_pred_binary", baseline_auc: float = BASELINE_AUC) -> DataFrame:
    """Summary row: roc_auc, class-1 precision/recall/f1, accuracy, AUC delta to a baseline."""
    rep = classification_report(df, y, pred)
    cols = ["roc_auc", "n_pos", "n_neg", "precision_1", "recall_1", "f1_1", "accuracy"]

    def pad(frame, have):
        return frame.select(*[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in cols])
    one = rep.where(F.col("label") == "1").select(
        F.col("precision").alias("precision_1"), F.col("recall").alias("recall_1"), F.col("f1").alias("f1_1"))
    acc = rep.where(F.col("label") == "accuracy").select(F.col("f1").alias("accuracy"))
    auc = roc_auc(df, y, score)
    # one-row results folded into one row (no product join)
    parts = pad(auc, auc.columns).unionByName(pad(one, one.columns)).unionByName(pad(acc, acc.columns))
    out = parts.agg(*[F.max(c).alias(c) for c in cols]).withColumns(
        {"n_pos": F.col("n_pos").cast("long"), "n_neg": F.col("n_neg").cast("long")})
    return out.withColumn("auc_delta", F.col("roc_auc") - F.lit(float(baseline_auc)))
