"""Sources and sinks: schema-pinned CSV/parquet reads, versioned datasets,
reports, a run log and a model registry — all plain DataFrame reads/writes
against one ``base_uri`` (``file:``, ``s3a:``, ``gs:`` ... resolved by Hadoop).

Datasets are one parquet folder partitioned by ``version=`` / ``split=``:
choosing a version or split is a partition filter (pruned at planning).  What
was written whole is recorded in a small commit table beside the data, which
tells the latest version (``YYYYmmdd_HHMMSS`` sorts by time) and its splits.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.features import INDEX_PREFIX, drop_index_columns

# Version format and pattern.
VERSION_FORMAT = "%Y%m%d_%H%M%S"
VERSION_PATTERN = r"^\d{8}_\d{6}$"
LATEST_ALIASES = (None, "", "latest")
SPLITS = ("train", "test", "pred")

TX_SCHEMA = T.StructType([
    T.StructField("trans_date_trans_time", T.StringType()),
    T.StructField("cc_num", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("city_pop", T.LongType()),
    T.StructField("job", T.StringType()),
    T.StructField("dob", T.StringType()),
    T.StructField("trans_num", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("merch_lat", T.DoubleType()),
    T.StructField("merch_long", T.DoubleType()),
    T.StructField("is_fraud", T.IntegerType()),
])

RUNS_SCHEMA = "run_id string, kind string, ts timestamp, params map<string,string>, metrics map<string,double>"


def new_version(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime(VERSION_FORMAT)


def check_version(v: str | None) -> str | None:
    """None / '' / 'latest' -> None (meaning latest); else must match the pattern."""
    if v in LATEST_ALIASES:
        return None
    if not re.match(VERSION_PATTERN, v):
        raise ValueError(f"version must match YYYYmmdd_HHMMSS, got {v!r}")
    return v


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = TX_SCHEMA, header: bool = True,
             infer: bool = False) -> DataFrame:
    """CSV scan with a pinned schema (inference only on request).  A leading
    index column written by pandas (empty or ``Unnamed: 0`` header) is
    recognised from the header line and dropped."""
    r = spark.read.option("header", header)
    if schema is None or infer:
        df = r.option("inferSchema", True).csv(path)
        return drop_index_columns(df.withColumnRenamed("_c0", "Unnamed: 0"))
    names = r.csv(path).columns if header else []
    lead = bool(names) and (names[0] in ("_c0", "") or names[0].startswith(INDEX_PREFIX)) \
        and len(names) == len(schema.fields) + 1
    full = T.StructType([T.StructField("Unnamed: 0", T.StringType())] + list(schema.fields)) if lead else schema
    return drop_index_columns(r.schema(full).csv(path))


def read_table_any(spark: SparkSession, path: str, fmt: str = "parquet", **opts) -> DataFrame:
    return drop_index_columns(spark.read.format(fmt).options(**opts).load(path))


def records_to_frame(spark: SparkSession, records: list[dict], schema: T.StructType | None = TX_SCHEMA) -> DataFrame:
    """Inline records (a request body) -> DataFrame."""
    if schema is None:
        return spark.createDataFrame(records)
    rows = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(rows, schema)


COMMITS_SCHEMA = "version string, split string, n_rows long, n_pos long, ts timestamp"


def commit_version(spark: SparkSession, base: str, version: str, splits: dict[str, tuple[int, int | None]]) -> None:
    """Record written splits {split: (rows, positives)} of a version in ``{base}/_commits`` (append-only): readers
    see what is recorded here, so a version whose write failed half-way is none."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(version, split, n, pos, now) for split, (n, pos) in splits.items()]
    spark.createDataFrame(rows, COMMITS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/_commits")


def write_versioned(df: DataFrame, base: str, version: str, split: str | None = None, fmt: str = "parquet", label: str | None = None) -> str:
    """Write (version, split) partitions and record them; other partitions are untouched.

    Without ``split`` the rows bring a column of that name.  Rows and positives (of ``label``) are counted while
    they're written."""
    out = df.withColumn("version", F.lit(version))
    out = out if split is None else out.withColumn("split", F.lit(split))
    names = [split] if split else list(SPLITS)
    seen = Observation()
    is_pos = (F.col(label) == 1) if label else F.lit(False)
    counts = [x for i, s in enumerate(names) for x in (
        F.count_if(F.col("split") == s).alias(f"n{i}"), F.count_if((F.col("split") == s) & is_pos).alias(f"p{i}"))]
    (out.observe(seen, *counts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("version", "split").format(fmt).save(base))
    got = seen.get
    commit_version(df.sparkSession, base, version, {s: (got[f"n{i}"], got[f"p{i}"] if label else None)
                                                    for i, s in enumerate(names) if split or got[f"n{i}"]})
    return version


def _not_found(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it's missing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory()] if fs.exists(folder) else []


def commits(spark: SparkSession, base: str) -> DataFrame:
    """(version, split, n_rows, n_pos, ts): the last record of each written split.  No dataset file is opened; of a
    dataset that has no records the names of its partition folders are listed."""
    try:
        found = spark.read.schema(COMMITS_SCHEMA).parquet(f"{base}/_commits")
    except AnalysisException as e:
        if not _not_found(e):
            raise
        named = [(v[8:], s[6:], None, None, None) for v in _folders(spark, base) if v.startswith("version=")
                 for s in _folders(spark, f"{base}/{v}") if s.startswith("split=")]
        return spark.createDataFrame(named, COMMITS_SCHEMA)
    last = F.max_by(F.struct("n_rows", "n_pos", "ts"), "ts").alias("r")
    return found.groupBy("version", "split").agg(last).select("version", "split", "r.*")


def latest_version(spark: SparkSession, base: str) -> str:
    """Largest recorded ``version`` (lexical order = time order)."""
    v = commits(spark, base).agg(F.max("version")).first()[0]
    if v is None:
        raise FileNotFoundError(f"no versions under {base}")
    return v


def read_versioned(spark: SparkSession, base: str, version: str | None = None, split: str | None = None) -> DataFrame:
    """Rows of one version (latest when None) and optionally one split;
    both are partition filters, so only those folders are listed and read."""
    v = check_version(version) or latest_version(spark, base)
    df = spark.read.parquet(base).where(F.col("version") == v)
    if split:
        df = df.where(F.col("split") == split)
    return df


def read_eval_split(spark: SparkSession, base: str, version: str | None = None) -> DataFrame:
    """Evaluation rows: the 'test' split, else the 'pred' split, else an error; which there are is recorded."""
    v = check_version(version) or latest_version(spark, base)
    splits = {r["split"] for r in commits(spark, base).where(F.col("version") == v).select("split").collect()}
    for s in ("test", "pred"):
        if s in splits:
            return read_versioned(spark, base, v, s)
    raise FileNotFoundError(f"no test or pred split for version {v} under {base}")


def write_frame(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **opts) -> str:
    w = df.write.mode(mode).format(fmt).options(**opts)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    return path


def write_report_json(df: DataFrame, path: str) -> str:
    """A small report table (one row per class / column) as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def log_run(spark: SparkSession, base: str, kind: str, params: dict, metrics: dict,
            run_id: str | None = None) -> str:
    """Append one row to the run log table ``{base}/runs``."""
    run_id = run_id or uuid.uuid4().hex
    row = [(run_id, kind, datetime.now(timezone.utc).replace(tzinfo=None),
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items() if v is not None})]
    spark.createDataFrame(row, RUNS_SCHEMA).write.mode("append").parquet(f"{base.rstrip('/')}/runs")
    return run_id


def read_runs(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/runs")


# ---------------------------------------------------------------- model registry
REGISTRY_SCHEMA = "model_name string, version string, path string, ts timestamp"


def model_path(base: str, model_name: str, version: str) -> str:
    return f"{base.rstrip('/')}/models/{model_name}/version={version}"


def register_model(spark: SparkSession, base: str, model_name: str, version: str, path: str | None = None) -> str:
    """Record a saved model in ``{base}/models/_registry`` (append-only)."""
    p = path or model_path(base, model_name, version)
    spark.createDataFrame([(model_name, version, p, datetime.now(timezone.utc).replace(tzinfo=None))],
                          REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/models/_registry")
    return p


def publish_model(spark: SparkSession, base: str, model_name: str, save: Callable[[str], object],
                  version: str | None = None) -> tuple[str, str]:
    """Save a model aside, under a folder of its own, and register it once it's whole: (path, version).

    The registry row is the commit: a failed save is never resolved, nothing published is overwritten, and of two
    models of one second the one registered last is the latest."""
    version = version or new_version()
    path = f"{model_path(base, model_name, version)}/{uuid.uuid4().hex}"
    save(path)
    return register_model(spark, base, model_name, version, path), version


def resolve_model(spark: SparkSession, base: str, model_name: str | None = None, version: str | None = None) -> str:
    """Path of a model: a given version, or the latest one (by version, then
    by name descending when no name is given)."""
    try:
        reg = spark.read.schema(REGISTRY_SCHEMA).parquet(f"{base.rstrip('/')}/models/_registry")
    except AnalysisException as e:
        if not _not_found(e):
            raise
        raise FileNotFoundError(f"no models under {base}") from e
    if model_name:
        reg = reg.where(F.col("model_name") == model_name)
    v = check_version(version)
    if v:
        reg = reg.where(F.col("version") == v)
    row = reg.orderBy(F.desc("version"), F.desc("model_name"), F.desc("ts"), F.desc("path")).select("path").first()
    if row is None:
        raise FileNotFoundError(f"no model {model_name or '*'} version {version or 'latest'} under {base}")
    return row[0]
