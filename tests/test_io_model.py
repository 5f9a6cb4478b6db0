import os

import pytest
from pyspark.sql import functions as F

from riskframe.operators import model as mo
from riskframe.plans import jobs
from riskframe.sources import io
from riskframe.sources.transactions import transactions
from tests.conftest import SF_SMALL


def test_version_rules():
    assert io.check_version(None) is None and io.check_version("latest") is None and io.check_version("") is None
    assert io.check_version("20250611_233203") == "20250611_233203"
    with pytest.raises(ValueError):
        io.check_version("2025-06-11")
    assert len(io.new_version()) == 15


def test_csv_with_index_column(spark, scratch, raw_fixture):
    pdf = raw_fixture.toPandas()
    path = os.path.join(scratch, "raw.csv")
    pdf.to_csv(path)  # pandas writes the index as an unnamed first column
    df = io.read_csv(spark, path)
    assert df.columns == [f.name for f in io.TX_SCHEMA.fields]
    assert df.count() == 4 and df.where("amt = 250.0").count() == 1


def test_versioned_datasets_latest_and_pruning(spark, scratch):
    base = os.path.join(scratch, "ds")
    df = spark.range(10).withColumnRenamed("id", "k")
    io.write_versioned(df, base, "20240101_000000", "train")
    io.write_versioned(df.limit(3), base, "20240101_000000", "test")
    io.write_versioned(df.limit(5), base, "20240202_000000", "pred")
    assert io.latest_version(spark, base) == "20240202_000000"
    assert io.read_versioned(spark, base, None).count() == 5
    assert io.read_versioned(spark, base, "20240101_000000", "test").count() == 3
    assert io.read_eval_split(spark, base, "20240101_000000").count() == 3
    assert io.read_eval_split(spark, base).count() == 5  # no test split: falls back to pred
    plan = io.read_versioned(spark, base, "20240101_000000", "test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "20240101_000000" in plan


def test_run_log_and_registry(spark, scratch):
    io.log_run(spark, scratch, "train", {"a": 1}, {"auc": 0.9})
    io.log_run(spark, scratch, "validate", {}, {"auc": 0.8, "none": None})
    assert io.read_runs(spark, scratch).count() == 2
    io.register_model(spark, scratch, "m", "20240101_000000")
    io.register_model(spark, scratch, "m", "20240301_000000")
    io.register_model(spark, scratch, "n", "20240201_000000")
    assert io.resolve_model(spark, scratch, "m").endswith("version=20240301_000000")
    assert io.resolve_model(spark, scratch, "m", "20240101_000000").endswith("version=20240101_000000")
    with pytest.raises(FileNotFoundError):
        io.resolve_model(spark, scratch, "zzz")


def test_jobs_end_to_end(spark, scratch):
    tx = transactions(spark, SF_SMALL)
    v = jobs.run_preprocessing(spark, tx, scratch)
    ds = spark.read.parquet(os.path.join(scratch, "datasets")).where(F.col("version") == v)
    counts = {r["split"]: r["count"] for r in ds.groupBy("split").count().collect()}
    assert counts == {"train": 1200, "test": 300}
    assert dict(ds.dtypes)["category"] == "double"  # encoded
    r = jobs.run_training(spark, scratch, v, "test")
    assert 1 <= r["info"]["best_round"] <= r["info"]["rounds_run"] == 10
    reply = r["summary"].first()
    assert abs(reply["auc_improvement"] - (reply["roc_auc"] - 0.74)) < 1e-12 and reply["params"]["early_stopping_rounds"] == "50"
    logged = io.read_runs(spark, scratch).first()["params"]
    assert logged["dataset_version"] == v and logged["train_rows"] == "1200" and 0 < float(logged["positive_rate"]) < 0.5
    assert r["metrics"]["roc_auc"] > 0.8  # the label is learnable
    checks = jobs.run_data_checks(spark, scratch, v)
    assert {x["split"]: x["n_rows"] for x in checks["shapes"].collect()} == {"train": 1200, "test": 300}
    assert checks["non_numeric"] == [] and checks["cardinality"].count() == 0 and checks["preview"].count() == 0
    shares = checks["balance"].groupBy("split").agg(F.sum("freq").alias("f")).collect()
    assert all(abs(x["f"] - 1) < 1e-12 for x in shares) and len(shares) == 2
    val = jobs.run_validation(spark, scratch)
    assert abs(val["metrics"]["roc_auc"] - r["metrics"]["roc_auc"]) < 1e-12
    ft = jobs.run_fine_tuning(spark, scratch, v, "gbt", learning_rate=0.1, epochs=2)
    assert ft["mode"] == "continue" and ft["info"]["rounds_run"] >= 1
    out = jobs.run_prediction(spark, scratch, jobs.load_splits(spark, scratch, v)[1], os.path.join(scratch, "scored"),
                              model_name="gbt_finetuned")
    scored = spark.read.parquet(out)
    assert scored.count() == 300 and {"is_fraud_pred", "fraud_score"} <= set(scored.columns)
    pv = jobs.run_preprocessing(spark, tx, scratch, for_prediction=True)
    assert spark.read.parquet(os.path.join(scratch, "datasets")).where(F.col("version") == pv).where("split = 'pred'").count() == 1500
    kinds = sorted(r["kind"] for r in io.read_runs(spark, scratch).collect())
    assert kinds == ["fine_tune", "train", "validate"]


def test_fine_tune_zero_rounds_equals_base(spark):
    from riskframe.operators.features import build_features
    f = build_features(transactions(spark, SF_SMALL)).drop("merchant", "category", "gender", "state", "job")
    feats = ["cc_num", "amt", "zip", "city_pop", "age", "hour", "dayofweek", "month", "distance_km"]
    base = mo.fit_gbt(f, feats, preset="test")
    cont, info = mo.fine_tune(base, f, f, epochs=0)
    # the trees read from the pipeline score as the pipeline does
    a = {r["trans_num"]: r["fraud_score"] for r in mo.score(base, f).collect()}
    b = {r["trans_num"]: r["fraud_score"] for r in mo.score(cont, f).collect()}
    assert info["rounds_kept"] == 0 and max(abs(a[k] - b[k]) for k in a) < 1e-9
    cont2, info2 = mo.fine_tune(base, f, f, learning_rate=0.1, epochs=3, patience=3)
    aucs = [info2["start_auc"], *info2["history"]]
    assert info2["best_auc"] == max(aucs) and info2["rounds_kept"] == aucs.index(max(aucs))
    assert info2["params"]["l2"] == 10.0 and info2["params"]["bagging_temperature"] == 1.0


def test_a_continuation_can_be_continued(spark, scratch):
    from riskframe.operators.features import build_features
    f = build_features(transactions(spark, SF_SMALL)).drop("merchant", "category", "gender", "state", "job").checkpoint()
    base = mo.fit_gbt(f, ["amt", "age", "hour"], preset="test", overrides={"maxIter": 2, "maxDepth": 2})
    first, info1 = mo.fine_tune(base, f, f, learning_rate=0.2, epochs=4)
    assert info1["rounds_kept"] > 0
    mo.save_model(first, f"{scratch}/first")
    second, info2 = mo.fine_tune(mo.load_model(f"{scratch}/first"), f, f, learning_rate=0.1, epochs=4)
    assert second.rates[2:] == [0.2] * info1["rounds_kept"] + [0.1] * info2["rounds_kept"]
    mo.save_model(second, f"{scratch}/second")
    again = mo.load_model(f"{scratch}/second")
    a, b = ({r["trans_num"]: r["fraud_score"] for r in mo.score(m, f).collect()} for m in (second, again))
    assert a == b and again.features == ["amt", "age", "hour"]
    assert info2["best_auc"] >= info1["best_auc"] - 1e-9
    with pytest.raises(mo.IncompatibleModel, match="amt"):
        mo.fine_tune(again, f.drop("amt"), f.drop("amt"), epochs=1)
    with pytest.raises(ValueError, match="missing features: .'age'"):
        mo.score(again, f.drop("age"))
    with pytest.raises(ValueError, match="missing features: .'age'"):
        mo.score(base, f.drop("age"))


def test_missing_path_raises(spark, scratch):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        spark.read.parquet(os.path.join(scratch, "nope")).count()
    os.makedirs(os.path.join(scratch, "empty"))
    with pytest.raises(FileNotFoundError):
        io.latest_version(spark, os.path.join(scratch, "empty"))


def test_early_stopping_and_fallback(spark):
    from riskframe.operators.features import build_features
    f = build_features(transactions(spark, SF_SMALL)).drop("merchant", "category", "gender", "state", "job")
    feats = ["cc_num", "amt", "zip", "city_pop", "age", "hour", "dayofweek", "month", "distance_km"]
    tr, va = f.where("trans_num % 5 <> 0"), f.where("trans_num % 5 = 0")
    m = mo.fit_gbt(tr, feats, preset="fast", validation=va, validation_tol=0.5)
    assert m.stages[-1].getNumTrees < 150  # stopped before the preset's 150 rounds
    fb, info = mo.retrain_fallback(tr, va, feats, epochs=3, learning_rate=0.1)
    assert set(fb.rates) <= {0.05} and len(fb.trees) == info["best_round"] <= 9 and max(len(t.leaves) for t in fb.trees) <= 16
    assert info["params"]["early_stopping_rounds"] == 3


def test_fine_tune_falls_back_when_base_cannot_continue(spark, scratch):
    tx = transactions(spark, SF_SMALL)
    v = jobs.run_preprocessing(spark, tx, scratch)
    # register a "model" trained on other feature names: the continuation cannot score the data
    from riskframe.operators.features import build_features
    other = build_features(tx).withColumnRenamed("amt", "amount")
    base = mo.fit_gbt(other.drop("merchant", "category", "gender", "state", "job"),
                      ["cc_num", "amount", "age"], preset="test")
    mo.save_model(base, io.register_model(spark, scratch, "odd", "20240101_000000"))
    ft = jobs.run_fine_tuning(spark, scratch, v, "odd", epochs=2)
    assert ft["mode"] == "fallback" and ft["metrics"]["roc_auc"] > 0.5


def test_monitor_writes_reports(spark, scratch):
    from riskframe.operators.features import build_features
    f = build_features(transactions(spark, SF_SMALL))
    res = jobs.run_monitoring(spark, f.where("trans_num % 2 = 0"), f.where("trans_num % 2 = 1"), base=scratch,
                              key="trans_num")
    reports = os.listdir(os.path.join(scratch, "reports"))
    assert len(reports) == 1
    for part in ("table", "verdict", "histograms"):
        assert spark.read.json(os.path.join(scratch, "reports", reports[0], part)).count() > 0
    assert res["verdict"].first()["n_columns"] == 15  # 14 features + label (key excluded)


def test_type_census(spark, raw_fixture):
    from riskframe.operators.profile import type_census
    d = {r["dtype"]: r["n_columns"] for r in type_census(raw_fixture).collect()}
    assert d == {"string": 14, "double": 5, "bigint": 2, "int": 1}


def test_inline_records_to_features(spark, raw_fixture):
    records = [r.asDict() for r in raw_fixture.collect()]
    df = io.records_to_frame(spark, records)
    from riskframe.operators.features import build_features
    out = build_features(df)
    assert out.count() == 4 and dict(out.dtypes)["cc_num"] == "bigint" and dict(out.dtypes)["zip"] == "int"


def test_prediction_mode_applies_stored_encoder(spark, scratch):
    tx = transactions(spark, SF_SMALL)
    v = jobs.run_preprocessing(spark, tx, scratch, version="20240101_000000")
    pv = jobs.run_preprocessing(spark, tx, scratch, for_prediction=True, encoder_version=v, version="20240102_000000")
    enc = spark.read.parquet(os.path.join(scratch, "encoders")).where(F.col("version") == v)
    stored = {r["value"]: r["enc"] for r in enc.where("feature = 'category'").collect()}
    raw_cat = {r["trans_num"]: r["category"] for r in tx.select("trans_num", "category").collect()}
    pred = io.read_versioned(spark, os.path.join(scratch, "datasets"), pv, "pred").select("trans_num", "category")
    for r in pred.limit(50).collect():
        assert abs(r["category"] - stored[raw_cat[r["trans_num"]]]) < 1e-12


def test_training_runs_at_the_full_preset_unless_told_otherwise(spark, monkeypatch):
    import inspect

    from riskframe.plans import catalog
    assert inspect.signature(jobs.run_training).parameters["preset"].default == "full"
    fitted = []
    fit = mo.fit_boosted

    def few_rounds(*a, preset, **how):
        fitted.append(preset)
        return fit(*a, preset=preset, overrides={"maxIter": 2, "maxDepth": 2}, **how)
    monkeypatch.setattr(mo, "fit_boosted", few_rounds)
    for name in ("train_evaluate", "train_evaluate_fast", "train_evaluate_full"):
        assert "1" in {r["label"] for r in catalog.QUERIES[name](spark, SF_SMALL).collect()}
    assert fitted == ["test", "fast", "full"]


def test_versions_are_told_without_opening_the_data(spark, scratch):
    base = os.path.join(scratch, "ds")
    df = spark.range(10).withColumn("is_fraud", (F.col("id") % 5 == 0).cast("int"))
    io.write_versioned(df, base, "20240101_000000", "train", label="is_fraud")
    io.write_versioned(df.withColumn("split", F.when(F.col("id") < 3, "test").otherwise("train")), base, "20240303_000000", label="is_fraud")
    found = io.commits(spark, base)
    files = found._jdf.queryExecution().optimizedPlan().toString()
    assert {os.path.basename(os.path.dirname(f)) for f in found.inputFiles()} == {"_commits"} and "version" in files
    assert sorted(tuple(r)[:4] for r in found.collect()) == [
        ("20240101_000000", "train", 10, 2), ("20240303_000000", "test", 3, 1), ("20240303_000000", "train", 7, 1)]
    # a write that broke off leaves folders, but no version
    df.withColumns({"version": F.lit("20250101_000000"), "split": F.lit("train")}).write.mode("append").partitionBy("version", "split").parquet(base)
    assert io.latest_version(spark, base) == "20240303_000000"
    # written again: the last record counts
    io.write_versioned(df.limit(4), base, "20240101_000000", "train")
    assert io.commits(spark, base).where("version = '20240101_000000'").first()["n_rows"] == 4
    # a dataset without records: the names of its folders
    old = os.path.join(scratch, "old")
    df.withColumns({"version": F.lit("20230101_000000"), "split": F.lit("pred")}).write.partitionBy("version", "split").parquet(old)
    assert io.latest_version(spark, old) == "20230101_000000" and io.read_eval_split(spark, old).count() == 10


def test_only_whole_models_are_published(spark, scratch):
    from riskframe.operators.boosting import Boosted, tree_of
    models = [Boosted(["a"], [tree_of([(-1, 0.0, -1, -1, float(v))])], [1.0]) for v in (1, 2)]
    with pytest.raises(FileNotFoundError):
        io.resolve_model(spark, scratch)
    paths = [io.publish_model(spark, scratch, "m", lambda p, m=m: mo.save_model(m, p), "20240101_000000")[0] for m in models]
    assert paths[0] != paths[1]  # two of one second

    def broken(path):
        mo.save_model(models[0], path)
        raise OSError("lost")
    with pytest.raises(OSError):
        io.publish_model(spark, scratch, "m", broken, "20250101_000000")
    latest = io.resolve_model(spark, scratch, "m")
    assert latest == paths[1] and mo.load_model(latest).trees[0].value[0] == 2.0
    assert mo.load_model(paths[0]).trees[0].value[0] == 1.0
