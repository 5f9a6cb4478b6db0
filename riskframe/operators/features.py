"""Feature engineering: raw transactions -> model features (narrow stage, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import age_years, haversine_km, weekday_mon0

# Columns removed before feature building, geo columns consumed
# by the distance, categorical columns that are target encoded, the label.
DROP_COLUMNS = ["first", "last", "street", "trans_num", "unix_time", "city"]
GEO_COLUMNS = ["lat", "long", "merch_lat", "merch_long"]
CATEGORICAL_COLUMNS = ["category", "job", "state", "merchant", "gender"]
LABEL = "is_fraud"
KEY = "trans_num"
FEATURE_COLUMNS = ["cc_num", "merchant", "category", "amt", "gender", "state", "zip", "city_pop",
                   "job", "age", "hour", "dayofweek", "month", "distance_km"]
INDEX_PREFIX = "Unnamed:"
NUMERIC_CASTS = {"cc_num": "bigint", "zip": "int"}


def drop_index_columns(df: DataFrame) -> DataFrame:
    """Strip CSV index columns (``Unnamed: 0`` ...) left by pandas writers."""
    junk = [c for c in df.columns if c.startswith(INDEX_PREFIX)]
    return df.drop(*junk) if junk else df


def parse_times(df: DataFrame, on_bad_ts: str = "raise") -> DataFrame:
    """Parse ``trans_date_trans_time`` and ``dob`` when they arrive as text.

    ``on_bad_ts='raise'`` keeps Spark's ANSI error on unparsable text;
    ``'null'`` turns such values into NULL.
    """
    ts, dob = F.col("trans_date_trans_time"), F.col("dob")
    types = dict(df.dtypes)
    if types.get("trans_date_trans_time") == "string":
        ts = F.try_to_timestamp(ts) if on_bad_ts == "null" else F.to_timestamp(ts)
    elif types.get("trans_date_trans_time") == "timestamp_ntz":
        ts = ts.cast("timestamp")
    if types.get("dob") == "string":
        dob = F.try_to_date(dob) if on_bad_ts == "null" else F.to_date(dob)
    elif types.get("dob") in ("timestamp", "timestamp_ntz"):
        dob = F.to_date(dob)
    return df.withColumns({"trans_date_trans_time": ts, "dob": dob})


def build_features(df: DataFrame, log_amt: bool = True, keep_key: bool = True,
                   on_bad_ts: str = "raise") -> DataFrame:
    """Raw transactions -> features (age, hour, weekday, month, distance, log amount).

    One projection over the input: Catalyst fuses it into the scan's
    whole-stage-codegen span and prunes every column not used below.
    """
    drop = [c for c in DROP_COLUMNS if not (keep_key and c == KEY)]
    df = drop_index_columns(df).drop(*drop)
    df = parse_times(df, on_bad_ts)
    ts = F.col("trans_date_trans_time")
    df = df.withColumns({
        "age": age_years(ts, "dob"),
        "hour": F.hour(ts),
        "dayofweek": weekday_mon0(ts),
        "month": F.month(ts),
        "distance_km": haversine_km("lat", "long", "merch_lat", "merch_long"),
    }).drop("trans_date_trans_time", "dob", *GEO_COLUMNS)
    # card number and zip are numeric features (text in the raw API schema)
    types = dict(df.dtypes)
    casts = {c: F.col(c).cast(t) for c, t in NUMERIC_CASTS.items() if types.get(c) == "string"}
    if casts:
        df = df.withColumns(casts)
    if log_amt:
        df = df.withColumn("amt", F.log1p("amt"))
    return df


def class_weight(df: DataFrame, weight: float, label: str = LABEL, out: str = "weight") -> DataFrame:
    """Per-row class weight ``[1, w]`` (label 1 gets ``w``), usable as ``weightCol``."""
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))


def align_features(df: DataFrame, feature_names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Reorder to a model's feature list, ignore extras, fail on missing ones.

    Index columns are not re-created: they are stripped at read time.
    """
    present = set(df.columns)
    wanted = [c for c in feature_names if not c.startswith(INDEX_PREFIX)]
    missing = [c for c in wanted if c not in present]
    if missing:
        raise ValueError(f"missing features: {missing}")
    extra_keep = [c for c in (keep or []) if c in present and c not in wanted]
    return df.select(*wanted, *extra_keep)


def feature_set_difference(df: DataFrame, feature_names: list[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) column names versus a model's feature list."""
    cols = set(df.columns)
    feats = set(feature_names)
    return sorted(feats - cols), sorted(cols - feats)


def non_numeric_columns(df: DataFrame) -> list[str]:
    """Columns that are not numeric (``select_dtypes('object')``)."""
    numeric = ("int", "bigint", "smallint", "tinyint", "double", "float", "boolean")
    return [c for c, t in df.dtypes if not (t in numeric or t.startswith("decimal"))]


def where_label(df: DataFrame, value: int, label: str = LABEL) -> DataFrame:
    return df.where(F.col(label) == value)


def where_amount_below(df: DataFrame, limit: float, col: str = "amt") -> DataFrame:
    return df.where(F.col(col) < limit)
