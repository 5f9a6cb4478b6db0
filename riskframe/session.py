"""Session helpers: sensible defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of tables no longer referenced are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "riskframe",
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults this library assumes."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("RISKFRAME_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is used
    as is; a cluster session without it is an error.  Only a local-mode
    session (tests) without the setting gets a fresh scratch folder, so
    lineage cuts never land on a machine-local path in production.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for cluster runs")
        d = tempfile.mkdtemp(prefix="riskframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def prepare_session(spark: SparkSession) -> SparkSession:
    """Settings every operator assumes, applied to a session made elsewhere:
    UTC session time (calendar parts and epoch seconds) and a checkpoint folder."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    # Python workers import the task functions of this package by name
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever file system it is on; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables written under the shared checkpoint folder and read again.

    Like ``checkpoint()`` this cuts lineage, but the tables are compressed
    columnar files, and each can be dropped as soon as the next one is written:
    an iterative job holds two of its states on disk, not all of them.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.tables = spark, f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.tables}"
        self.tables += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_before(self, keep: int) -> None:
        """Delete all tables but the last ``keep``."""
        for i in range(self.tables - keep):
            delete_folder(self.spark, f"{self.folder}/{i}")
