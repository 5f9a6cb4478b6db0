import math

from pyspark.sql import functions as F

from riskframe.functions.columns import haversine_km
from riskframe.operators import features as fe


def test_preprocess_structure(raw_fixture):
    out = fe.build_features(raw_fixture, keep_key=False)
    cols = set(out.columns)
    assert {"age", "distance_km", "amt", "is_fraud", "hour", "dayofweek", "month"} <= cols
    assert not {"first", "last", "street", "trans_num", "unix_time", "city", "lat", "long", "dob"} & cols
    assert out.count() == 4


def test_feature_values(raw_fixture):
    rows = {r["trans_num"]: r for r in fe.build_features(raw_fixture).collect()}
    assert [rows[k]["age"] for k in ("txn1", "txn2", "txn3", "txn4")] == [40, 30, 40, 45]
    assert all(r["dayofweek"] == 6 and r["hour"] == 12 and r["month"] == 6 for r in rows.values())  # a Sunday
    assert abs(rows["txn1"]["amt"] - math.log1p(100.0)) < 1e-12
    assert rows["txn1"]["distance_km"] > 0


def test_log_amount_optional(raw_fixture):
    out = fe.build_features(raw_fixture, log_amt=False)
    assert sorted(r["amt"] for r in out.collect()) == [15.0, 40.0, 100.0, 250.0]


def _np_haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_haversine_properties(spark):
    df = spark.createDataFrame([(34.05, -118.25, 34.06, -118.26), (10.0, 20.0, 10.0, 20.0), (-33.9, 151.2, 51.5, -0.1)],
                               "a double, b double, c double, d double")
    r = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y")).collect()
    assert r[0]["x"] > 0 and isinstance(r[0]["x"], float)
    assert r[1]["x"] == 0.0
    for row, args in zip(r, [(34.05, -118.25, 34.06, -118.26), (10.0, 20.0, 10.0, 20.0), (-33.9, 151.2, 51.5, -0.1)]):
        assert abs(row["x"] - row["y"]) < 1e-9
        assert abs(row["x"] - _np_haversine(*args)) < 1e-6


def test_bad_timestamp_modes(spark, raw_fixture):
    bad = raw_fixture.withColumn("trans_date_trans_time", F.lit("not a time"))
    out = fe.build_features(bad, on_bad_ts="null")
    assert out.where(F.col("hour").isNull()).count() == 4


def test_align_and_index_columns(raw_fixture):
    df = raw_fixture.withColumn("Unnamed: 0", F.lit(1))
    assert "Unnamed: 0" not in fe.drop_index_columns(df).columns
    feats = fe.build_features(df)
    aligned = fe.align_features(feats, ["Unnamed: 0"] + list(reversed(fe.FEATURE_COLUMNS)))
    assert aligned.columns == list(reversed(fe.FEATURE_COLUMNS))
    missing, extra = fe.feature_set_difference(feats, fe.FEATURE_COLUMNS + ["nope"])
    assert missing == ["nope"] and "is_fraud" in extra
    try:
        fe.align_features(feats, ["nope"])
        raise AssertionError("expected a missing-feature error")
    except ValueError:
        pass


def test_class_weight_and_non_numeric(raw_fixture):
    w = fe.class_weight(fe.build_features(raw_fixture), 10.0)
    assert sorted(r["weight"] for r in w.collect()) == [1.0, 1.0, 10.0, 10.0]
    assert set(fe.non_numeric_columns(fe.build_features(raw_fixture))) == {"merchant", "category", "gender", "state", "job", "trans_num"}


def test_daily_counts_fill_empty_days_and_rate_order(spark):
    from riskframe.operators import profile as pr
    rows = [("2024-01-01 10:00:00", "a", 1), ("2024-01-01 11:00:00", "a", 0), ("2024-01-04 09:00:00", "b", 1),
            ("2024-01-04 23:59:59", "b", 1), ("2024-01-02 00:00:00", "c", 0)]
    df = spark.createDataFrame(rows, "ts string, category string, is_fraud int").withColumn(
        "trans_date_trans_time", F.to_timestamp("ts"))
    daily = {str(r["day"]): (r["n_pos"], r["n_rows"]) for r in pr.daily_counts(df).collect()}
    assert daily == {"2024-01-01": (1, 2), "2024-01-02": (0, 1), "2024-01-03": (0, 0), "2024-01-04": (2, 2)}
    order = [r["category"] for r in pr.rate_by_group(df, "category").collect()]
    assert order == ["b", "a", "c"]
