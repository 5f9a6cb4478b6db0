import math
import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskframe.operators import encode as en
from riskframe.operators import metrics as me

# The stored validation report (golden case for the report algebra).
GOLDEN = {
    "0": (0.9979042267771163, 0.9977600144515196, 0.9978321154037233, 110715),
    "1": (0.44269662921348313, 0.4592074592074592, 0.45080091533180777, 429),
    "macro avg": (0.7203004279952997, 0.7284837368294894, 0.7243165153677655, 111144),
    "weighted avg": (0.9957612045774943, 0.9956812783416109, 0.9957206529331368, 111144),
}
GOLDEN_ACCURACY = 0.9956812783416109


def test_classification_report_golden_confusion_matrix(spark):
    # TP 197, FN 232, FP 248, TN 110467
    tp, fn, fp = 197, 232, 248
    df = spark.range(111144).select(
        F.when(F.col("id") < tp + fn, 1).otherwise(0).alias("y_true"),
        F.when((F.col("id") < tp) | ((F.col("id") >= tp + fn) & (F.col("id") < tp + fn + fp)), 1).otherwise(0)
        .alias("y_pred_binary"))
    rep = {r["label"]: r for r in me.classification_report(df).collect()}
    for k, (p, r, f, s) in GOLDEN.items():
        assert abs(rep[k]["precision"] - p) < 1e-12 and abs(rep[k]["recall"] - r) < 1e-12
        assert abs(rep[k]["f1"] - f) < 1e-12 and rep[k]["support"] == s
    assert abs(rep["accuracy"]["f1"] - GOLDEN_ACCURACY) < 1e-12


def _brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_roc_auc_exact_with_ties(spark):
    rnd = random.Random(3)
    ys = [1 if rnd.random() < 0.2 else 0 for _ in range(700)]
    ss = [round(rnd.random() * 0.5 + 0.4 * y, 2) for y in ys]  # many ties
    df = spark.createDataFrame(list(zip(ys, ss)), "y_true int, y_pred_proba double").repartition(4)
    auc = me.roc_auc(df).first()["roc_auc"]
    assert abs(auc - _brute_auc(ys, ss)) < 1e-12
    flipped = me.roc_auc(df.withColumn("y_pred_proba", -F.col("y_pred_proba"))).first()["roc_auc"]
    assert abs(flipped - (1 - auc)) < 1e-12
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="s", numBins=0)
    builtin = ev.evaluate(df.select(F.col("y_true").cast("double").alias("label"), F.col("y_pred_proba").alias("s")))
    assert abs(builtin - auc) < 1e-9


def test_roc_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.3)], "y_true int, y_pred_proba double")
    assert me.roc_auc(df).first()["roc_auc"] is None


def test_target_encoder_formula_unknown_and_leakage(spark):
    rows = [("a", 1)] * 30 + [("a", 0)] * 10 + [("b", 0)] * 5 + [("c", None)] * 0
    train = spark.createDataFrame(rows, "category string, is_fraud int")
    enc = en.fit_target_encoder(train, ["category"]).collect()
    prior = 30 / 45
    d = {r["value"]: r["enc"] for r in enc}
    for v, n, mean in (("a", 40, 0.75), ("b", 5, 0.0)):
        w = 1 / (1 + math.exp(-(n - 20) / 10))
        assert abs(d[v] - (prior * (1 - w) + mean * w)) < 1e-12
    test = spark.createDataFrame([("a", 0), ("zzz", 1), (None, 1)], "category string, is_fraud int")
    out = en.apply_target_encoder(test, en.fit_target_encoder(train, ["category"]), ["category"]).collect()
    vals = sorted(r["category"] for r in out)
    assert abs(vals[0] - prior) < 1e-12 and abs(vals[1] - prior) < 1e-12  # unseen and NULL -> prior
    # test labels never reach the encoder: flipping them changes nothing
    flipped = test.withColumn("is_fraud", 1 - F.col("is_fraud"))
    out2 = en.apply_target_encoder(flipped, en.fit_target_encoder(train, ["category"]), ["category"]).collect()
    assert sorted(r["category"] for r in out2) == vals


def test_additive_encoder(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "category string, is_fraud int")
    d = {r["value"]: r["enc"] for r in en.fit_target_encoder(train, ["category"], method="additive").collect()}
    prior = 2 / 3
    assert abs(d["a"] - (prior * (1 - 2 / 12) + 0.5 * 2 / 12)) < 1e-12
