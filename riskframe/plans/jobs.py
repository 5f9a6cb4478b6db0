"""End-to-end jobs: preprocess, train, predict, validate, fine-tune, monitor.

Each job is a short composition of operators over one ``base`` folder:
``{base}/datasets`` (parquet, ``version=``/``split=`` partitions),
``{base}/encoders``, ``{base}/models`` (+ ``_registry``), ``{base}/runs``,
``{base}/reports``.  Intermediate tables that feed several actions are cut
with ``checkpoint()`` into the shared checkpoint folder.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import drift as dr
from riskframe.operators import encode as en
from riskframe.operators import model as mo
from riskframe.operators import profile as pr
from riskframe.operators import sampling as sm
from riskframe.operators import score_drift as sd
from riskframe.operators.features import FEATURE_COLUMNS, KEY, LABEL, build_features, non_numeric_columns
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources import io


def _p(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def run_preprocessing(spark: SparkSession, raw: DataFrame, base: str, log_amt: bool = True,
                      for_prediction: bool = False, test_size: float = 0.2, seed: int = 42,
                      encoder_version: str | None = None, version: str | None = None) -> str:
    """Features -> (split) -> target encoding -> versioned write.  Returns the version.

    Training mode fits the encoder on the train split only and stores it.
    Prediction mode applies a stored encoder when ``encoder_version`` is given,
    else refits on the rows themselves (which needs their labels).
    """
    ensure_checkpoint_dir(spark)
    version = version or io.new_version()
    feats = build_features(raw, log_amt=log_amt).checkpoint(eager=True)
    if for_prediction:
        if encoder_version:
            enc = spark.read.parquet(_p(base, "encoders")).where(F.col("version") == encoder_version).drop("version")
        else:
            enc = en.fit_target_encoder(feats)
        out = en.apply_target_encoder(feats, enc)
        io.write_versioned(out, _p(base, "datasets"), version, "pred", label=LABEL)
        return version
    # class sizes come from the split's own hash-bucket counts; the class guard runs on them
    split = sm.stratified_split(feats, KEY, LABEL, test_size, seed).checkpoint(eager=True)
    enc = en.fit_target_encoder(split.where("split = 'train'"))
    enc.withColumn("version", F.lit(version)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("version").parquet(_p(base, "encoders"))
    return io.write_versioned(en.apply_target_encoder(split, enc), _p(base, "datasets"), version, label=LABEL)


def _dataset_facts(spark: SparkSession, base: str, version: str | None, split: str = "train") -> dict:
    """What a run's log says of its data: version, rows and positive rate of the split, from the commit table."""
    ds = _p(base, "datasets")
    v = io.check_version(version) or io.latest_version(spark, ds)
    row = io.commits(spark, ds).where((F.col("version") == v) & (F.col("split") == split)).first()
    facts = {"dataset_version": v}
    if row is not None and row["n_rows"]:
        facts |= {f"{split}_rows": row["n_rows"]} | ({"positive_rate": row["n_pos"] / row["n_rows"]} if row["n_pos"] is not None else {})
    return facts


def load_splits(spark: SparkSession, base: str, version: str | None = None, test_mode: bool = False,
                sample_size: int = 5000, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    ds = _p(base, "datasets")
    v = io.check_version(version) or io.latest_version(spark, ds)
    train = io.read_versioned(spark, ds, v, "train").drop("version", "split")
    test = io.read_versioned(spark, ds, v, "test").drop("version", "split")
    if test_mode:
        train, test = sm.test_mode_samples(train, test, KEY, sample_size, seed)
    return train, test


def run_training(spark: SparkSession, base: str, version: str | None = None, preset: str = "full",
                 model_name: str = "gbt", test_mode: bool = False, overrides: dict | None = None,
                 validation_fraction: float = 0.1) -> dict:
    """Fit on the train split, evaluate on the test split, save, log.

    With ``validation_fraction`` > 0 a stratified slice of the train split is
    held out for early stopping, so the test split stays unseen until scoring.
    """
    t0 = time.time()
    train, test = load_splits(spark, base, version, test_mode)
    validation = None
    if validation_fraction > 0:
        cut = sm.stratified_split(train, KEY, LABEL, validation_fraction, seed=7, split_col="_part").checkpoint(eager=True)
        train = cut.where("_part = 'train'").drop("_part")
        validation = cut.where("_part = 'test'").drop("_part")
    model, info = mo.fit_boosted(train, validation, FEATURE_COLUMNS, LABEL, preset, overrides)
    report, summary = mo.evaluate_scored(mo.score(model, test))
    reply = mo.fit_summary(summary, info["params"]).checkpoint(eager=True)
    metrics = summary.first().asDict() | {"best_round": info["best_round"], "rounds_run": info["rounds_run"]}
    path, mv = io.publish_model(spark, base, model_name, lambda p: mo.save_model(model, p))
    metrics["training_time"] = time.time() - t0
    io.log_run(spark, base, "train", info["params"] | _dataset_facts(spark, base, version) | {"model_name": model_name, "model_version": mv}, metrics)
    return {"model_path": path, "model_version": mv, "metrics": metrics, "report": report, "summary": reply, "info": info}


def run_prediction(spark: SparkSession, base: str, data: DataFrame, out_path: str, model_name: str | None = None,
                   model_version: str | None = None, fmt: str = "parquet") -> str:
    """Score a table with a stored model and write it (one pass, one write)."""
    model = mo.load_model(io.resolve_model(spark, base, model_name, model_version))
    return io.write_frame(mo.score(model, data), out_path, fmt)


def run_validation(spark: SparkSession, base: str, model_name: str | None = None, model_version: str | None = None,
                   version: str | None = None, data: DataFrame | None = None) -> dict:
    """Evaluate a stored model on given rows, else on the version's test
    split (falling back to its pred split); writes the report and logs it."""
    model = mo.load_model(io.resolve_model(spark, base, model_name, model_version))
    rows = data if data is not None else io.read_eval_split(spark, _p(base, "datasets"), version).drop("version", "split")
    report, summary = mo.evaluate_scored(mo.score(model, rows))
    metrics = summary.first().asDict()
    io.write_report_json(report, _p(base, "reports", f"validation_{io.new_version()}"))
    io.log_run(spark, base, "validate", {"model_name": model_name or "latest"}, metrics)
    return {"report": report, "metrics": metrics}


def validate_predictions(table: DataFrame) -> dict:
    """Production mode: report + AUC straight on (y_true, y_pred_proba, y_pred_binary)."""
    from riskframe.operators.metrics import classification_report, roc_auc
    return {"report": classification_report(table), "auc": roc_auc(table)}


def run_fine_tuning(spark: SparkSession, base: str, version: str | None = None, model_name: str | None = None,
                    model_version: str | None = None, learning_rate: float = 0.01, epochs: int = 10,
                    new_name: str = "gbt_finetuned") -> dict:
    """Continue a stored model on the 95 % stratified (or rare-class) subset
    of the train split; fall back to a from-scratch model if it cannot continue."""
    t0 = time.time()
    train, test = load_splits(spark, base, version)
    subset = sm.rare_class_sample(train, KEY, LABEL).checkpoint(eager=True)
    base_path = io.resolve_model(spark, base, model_name, model_version)
    mode = "continue"
    # the rounds are chosen on a slice of the subset; the test split is only scored
    cut = sm.stratified_split(subset, KEY, LABEL, 0.1, seed=7, split_col="_part").checkpoint(eager=True)
    fit, validation = (cut.where(F.col("_part") == s).drop("_part") for s in ("train", "test"))
    base_model = mo.load_model(base_path)
    try:
        model, info = mo.fine_tune(base_model, fit, validation, LABEL, learning_rate, epochs)
    except mo.IncompatibleModel as e:
        mode = "fallback"
        model, info = mo.retrain_fallback(fit, validation, FEATURE_COLUMNS, LABEL, learning_rate, epochs)
        info["error"] = str(e)
    report, summary = mo.evaluate_scored(mo.score(model, test))
    reply = mo.fit_summary(summary, info["params"]).checkpoint(eager=True)
    metrics = summary.first().asDict() | {"best_round": info["best_round"], "rounds_run": info["rounds_run"]}
    path, mv = io.publish_model(spark, base, new_name, lambda p: mo.save_model(model, p))
    metrics["training_time"] = time.time() - t0
    params = info["params"] | {"mode": mode, "base_model": base_path, "model_name": new_name, "model_version": mv}
    io.log_run(spark, base, "fine_tune", params | _dataset_facts(spark, base, version), metrics)
    return {"model_path": path, "mode": mode, "metrics": metrics, "info": info, "report": report, "summary": reply}


def run_data_checks(spark: SparkSession, base: str, version: str | None = None) -> dict:
    """Checks of a preprocessed version: shapes and positives per split, type
    census, text columns with many values and the first of each, label balance
    per split as counts and frequencies."""
    ds = io.read_versioned(spark, _p(base, "datasets"), version).drop("version")
    feats = ds.drop("split", KEY)
    shapes = ds.groupBy("split").agg(F.count("*").alias("n_rows"), F.sum(LABEL).cast("long").alias("n_pos"))
    balance = ds.groupBy("split", LABEL).agg(F.count("*").alias("n")).checkpoint(eager=True)
    total = balance.groupBy("split").agg(F.sum("n").alias("_n"))  # a row a split
    balance = balance.join(F.broadcast(total), "split").select("split", LABEL, "n", (F.col("n") / F.col("_n")).alias("freq"))
    return {"shapes": shapes.withColumn("n_columns", F.lit(len(feats.columns) - 1)),
            "types": pr.type_census(feats.drop(LABEL)),
            "non_numeric": [c for c in non_numeric_columns(feats) if c != LABEL],
            "cardinality": pr.high_cardinality(feats.select(*[c for c, t in feats.dtypes if t == "string"])).where("high_cardinality"),
            "preview": pr.value_preview(feats.drop(LABEL)), "balance": balance}


def run_monitoring(spark: SparkSession, reference: DataFrame, current: DataFrame, base: str | None = None,
                   key: str | None = None, drift_share: float = dr.DEFAULT_DRIFT_SHARE) -> dict:
    """Drift report; with ``base`` the table, verdict and histograms are written as JSON."""
    res = dr.monitor(reference, current, key=key, drift_share=drift_share)
    if base:
        stamp = io.new_version()
        for k, v in res.items():
            io.write_report_json(v, _p(base, "reports", f"drift_{stamp}", k))
    return res


def track_scores(spark: SparkSession, base: str, scored: DataFrame, window: str = "month", reference: str | None = None,
                 **columns) -> DataFrame:
    """Store the daily sketches of newly scored rows (whole days; a day stored again replaces what was there) and
    compare the windows of all days so far with the reference window."""
    days = sd.daily_scores(scored, **columns)
    (days.withColumn("of", F.col("day")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("of").parquet(_p(base, "score_days")))
    return sd.score_drift(sd.merged(spark.read.parquet(_p(base, "score_days")).drop("of"), window), reference)


__all__ = ["track_scores", "run_preprocessing", "run_training", "run_prediction", "run_validation", "validate_predictions",
           "run_fine_tuning", "run_monitoring", "run_data_checks", "load_splits"]
