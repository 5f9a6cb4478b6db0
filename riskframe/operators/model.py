"""Boosted-tree models: fit, score, evaluate, continue (fine-tune) an existing
model, retrain fallback, validate.

Training data never leaves the executors: ``spark.ml`` aggregates split
statistics per partition; only trees (kilobytes) reach the driver.
``fit_boosted`` and ``fine_tune`` boost with regularised leaves and stop on
AUC (``boosting``); ``fit_gbt`` is ``GBTClassifier`` as it is.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.boosting import Boosted, boost
from riskframe.operators.features import FEATURE_COLUMNS, LABEL, align_features, class_weight
from riskframe.operators.metrics import BASELINE_AUC, classification_report, roc_auc
from riskframe.session import ensure_checkpoint_dir

# Training presets (rounds, learning rate, depth, positive-class weight).
PRESETS = {
    "test": {"maxIter": 10, "stepSize": 0.1, "maxDepth": 3, "class_weight": 10.0},
    "fast": {"maxIter": 150, "stepSize": 0.07, "maxDepth": 5, "class_weight": 15.0},
    "full": {"maxIter": 500, "stepSize": 0.05, "maxDepth": 6, "class_weight": 25.0},
}
SEED = 42
PATIENCE = 50  # rounds without a higher AUC after which a fit stops
L2 = 3.0  # of the leaves; the studied learner's default
FINE_TUNE_DEPTH = 4
FINE_TUNE_WEIGHT = 15.0
FINE_TUNE_L2 = 10.0
FINE_TUNE_BAGGING = 1.0


def fit_gbt(train: DataFrame, features: list[str] | None = None, label: str = LABEL, preset: str = "test",
            overrides: dict | None = None, validation: DataFrame | None = None,
            validation_tol: float = 0.01) -> PipelineModel:
    """``VectorAssembler`` + ``GBTClassifier`` (logistic loss, class weights).

    With ``validation`` rows, boosting stops once the validation loss stops
    improving by ``validation_tol`` (Spark's loss-based early stop).
    """
    ensure_checkpoint_dir(train.sparkSession)
    p = dict(PRESETS[preset])
    p.update(overrides or {})
    features = features or FEATURE_COLUMNS
    df = class_weight(train, p["class_weight"], label)
    extra = {}
    if validation is not None:
        df = df.withColumn("_is_val", F.lit(False)).unionByName(
            class_weight(validation, p["class_weight"], label).withColumn("_is_val", F.lit(True)))
        extra = {"validationIndicatorCol": "_is_val", "validationTol": validation_tol}
    gbt = GBTClassifier(labelCol=label, featuresCol="features", weightCol="weight", maxIter=int(p["maxIter"]),
                        stepSize=float(p["stepSize"]), maxDepth=int(p["maxDepth"]), seed=SEED,
                        lossType="logistic", checkpointInterval=10, **extra)
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[asm, gbt]).fit(df)


def score(model, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Append ``is_fraud_pred`` and ``fraud_score`` (probability of class 1).  The model's features are found
    by name: further columns stay as they are, a missing one is an error that names it."""
    if not isinstance(model, Boosted):
        align_features(df, model.stages[0].getInputCols())
    out = model.transform(df)
    prob = F.col("probability") if dict(out.dtypes)["probability"].startswith("array") else vector_to_array("probability")
    out = out.withColumn("fraud_score", prob[1]).withColumn(
        "is_fraud_pred", F.col("prediction").cast("int"))
    drop = [c for c in ("features", "rawPrediction", "probability", "prediction", "_margin") if c in out.columns]
    return out.drop(*drop)


def evaluate_scored(scored: DataFrame, label: str = LABEL) -> tuple[DataFrame, DataFrame]:
    """(classification report, one-row summary: roc_auc, precision/recall/f1 of class 1)."""
    t = scored.select(F.col(label).alias("y_true"), F.col("is_fraud_pred").alias("y_pred_binary"),
                      F.col("fraud_score").alias("y_pred_proba"))
    rep = classification_report(t)
    one = rep.where(F.col("label") == "1").select(
        F.lit(None).cast("double").alias("roc_auc"), "precision", "recall", "f1")
    auc = roc_auc(t).select("roc_auc", *[F.lit(None).cast("double").alias(c) for c in ("precision", "recall", "f1")])
    # two one-row results folded into one row (no product join)
    summary = auc.unionByName(one).agg(*[F.max(c).alias(c) for c in ("roc_auc", "precision", "recall", "f1")])
    return rep, summary


def fit_summary(summary: DataFrame, params: dict, baseline_auc: float = BASELINE_AUC) -> DataFrame:
    """One row: metrics, AUC gain over a baseline, parameters as a map."""
    pm = F.create_map(*[x for k, v in params.items() for x in (F.lit(str(k)), F.lit(str(v)))])
    return summary.withColumn("auc_improvement", F.col("roc_auc") - F.lit(float(baseline_auc))).withColumn("params", pm)


def fit_boosted(train: DataFrame, validation: DataFrame | None, features: list[str] | None = None, label: str = LABEL,
                preset: str = "full", overrides: dict | None = None, patience: int = PATIENCE) -> tuple[Boosted, dict]:
    """Boosted trees at a preset, stopped by the AUC of the ``validation`` rows and cut at the best round;
    also {rounds_run, best_round, best_auc, history, params}."""
    p = {**PRESETS[preset], **(overrides or {})}
    l2 = float(p.get("l2", L2))
    model, info = boost(train, validation, features or FEATURE_COLUMNS, label, int(p["maxIter"]), float(p["stepSize"]),
                        int(p["maxDepth"]), float(p["class_weight"]), l2, patience)
    return model, info | {"params": p | {"preset": preset, "l2": l2, "early_stopping_rounds": patience}}


# ---------------------------------------------------------------- continuation
class IncompatibleModel(ValueError):
    """A stored model that can't be continued on the given columns."""


def as_boosted(model) -> Boosted:
    return model if isinstance(model, Boosted) else Boosted.of_pipeline(model)


def fine_tune(base, train: DataFrame, validation: DataFrame, label: str = LABEL, learning_rate: float = 0.01,
              epochs: int = 10, depth: int = FINE_TUNE_DEPTH, weight: float = FINE_TUNE_WEIGHT, patience: int | None = None,
              l2: float = FINE_TUNE_L2, bagging: float = FINE_TUNE_BAGGING) -> tuple[Boosted, dict]:
    """Continue boosting ``base`` (boosted trees or a ``GBTClassifier`` pipeline) for up to ``epochs`` rounds; stop after
    ``patience`` (default ``max(2, epochs // 3)``) rounds without a higher validation AUC and keep the best prefix.
    Features are taken by the model's names: further columns are ignored, a missing one is an error."""
    model = as_boosted(base)
    try:
        align_features(train, model.features)
        align_features(validation, model.features)
    except ValueError as e:
        raise IncompatibleModel(str(e)) from e
    patience = patience if patience is not None else max(2, epochs // 3)
    tuned, info = boost(train, validation, model.features, label, epochs, learning_rate, depth, weight, l2, patience, start=model,
                        bagging=bagging)
    params = {"learning_rate": learning_rate, "epochs": epochs, "depth": depth, "class_weight": weight, "l2": l2,
              "bagging_temperature": bagging, "early_stopping_rounds": patience}
    return tuned, info | {"rounds_kept": info["best_round"], "params": params}


def retrain_fallback(train: DataFrame, validation: DataFrame, features: list[str] | None = None, label: str = LABEL,
                     learning_rate: float = 0.01, epochs: int = 10) -> tuple[Boosted, dict]:
    """From-scratch model used when a continuation is impossible: 3x rounds, half the learning rate, depth 4,
    positive weight 15, the same regularisation; stopped after ``epochs`` rounds without a higher AUC."""
    params = {"learning_rate": 0.5 * learning_rate, "epochs": 3 * epochs, "depth": FINE_TUNE_DEPTH, "class_weight": FINE_TUNE_WEIGHT,
              "l2": FINE_TUNE_L2, "bagging_temperature": FINE_TUNE_BAGGING, "early_stopping_rounds": epochs}
    model, info = boost(train, validation, features or FEATURE_COLUMNS, label, 3 * epochs, 0.5 * learning_rate, FINE_TUNE_DEPTH,
                        FINE_TUNE_WEIGHT, FINE_TUNE_L2, epochs, bagging=FINE_TUNE_BAGGING)
    return model, info | {"params": params}


# ---------------------------------------------------------------- stored models
def save_model(model, path: str) -> str:
    """Boosted trees or a ``PipelineModel``."""
    if isinstance(model, Boosted):
        model.save(path)
    else:
        model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """A saved ``Boosted`` (it has a ``meta`` file) or ``PipelineModel``."""
    try:
        SparkSession.getActiveSession().read.text(f"{path}/meta")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return PipelineModel.load(path)
    return Boosted.load(path)
