"""Structured Streaming variants of the stateless operators and a watermarked
daily aggregate.

The feature builder, the encoder apply (stream-static broadcast join) and
model scoring are stateless column work, so the batch functions accept a
``readStream`` DataFrame unchanged.  Daily counts use an event-time window
with a watermark, so state for closed days is dropped.  Sinks are parquet
folders; ``run_available_now`` processes what is there and stops
(``Trigger.AvailableNow``), the way a scheduled incremental job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.operators.features import build_features
from riskframe.sources.tables import table_path
from riskframe.sources.transactions import derive_transactions


def read_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet", name_glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    """File-source stream over a folder (optionally only file names matching ``name_glob``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Asks the path's own Hadoop file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table read as a stream (new files in the folder are picked up)."""
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    if is_folder(spark, path):  # a table of part files
        return read_stream(spark, path, schema, name_glob="*.parquet")
    return read_stream(spark, sf_dir, schema, name_glob=f"{name}.parquet")


def transactions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive as a stream; customer and nation are static dimensions."""
    orders = table_stream(spark, sf_dir, "orders")
    return derive_transactions(orders, spark.read.parquet(table_path(sf_dir, "customer")),
                               spark.read.parquet(table_path(sf_dir, "nation")))


def features_stream(spark: SparkSession, sf_dir: str, log_amt: bool = True) -> DataFrame:
    return build_features(transactions_stream(spark, sf_dir), log_amt=log_amt)


def daily_event_counts(events: DataFrame, ts: str = "ts", group: str = "event_type",
                       watermark: str = "1 day") -> DataFrame:
    """Events and value sum per (UTC day, group); late rows within the watermark count."""
    if dict(events.dtypes)[ts] == "timestamp_ntz":
        events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return (events.withWatermark(ts, watermark)
            .groupBy(F.window(ts, "1 day").alias("w"), group)
            .agg(F.count("*").alias("n"), F.sum("value").alias("value_sum"))
            .select(F.to_date(F.col("w.start")).alias("day"), group, "n", "value_sum"))


def daily_label_counts(stream: DataFrame, ts: str = "trans_date_trans_time", label: str = "is_fraud",
                       watermark: str = "1 day") -> DataFrame:
    """Positives and rows per UTC day of a transaction stream (days with rows)."""
    return (stream.withWatermark(ts, watermark)
            .groupBy(F.window(ts, "1 day").alias("w"))
            .agg(F.sum(label).cast("long").alias("n_pos"), F.count("*").alias("n_rows"))
            .select(F.to_date(F.col("w.start")).alias("day"), "n_pos", "n_rows"))


def run_available_now(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet") -> str:
    """Append-mode stream to a file sink: process available input, then stop."""
    q = (df.writeStream.format(fmt).option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def run_updates_available_now(df: DataFrame, sink: str, checkpoint: str) -> str:
    """Update-mode aggregate: each micro-batch writes its changed rows to its own partition
    (``_batch=id``) of a parquet change log, so a replayed batch replaces what it wrote before
    (``latest_state`` folds the log)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/_batch={batch_id}")
    q = (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def latest_state(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Last written row per key of an update change log."""
    w = Window.partitionBy(*keys).orderBy(F.desc("_batch"))
    return changes.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_batch")


def encode_stream(stream: DataFrame, encoder: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Apply a batch-fitted encoder table to a stream (stream-static joins;
    the encoder is size-checked and broadcast, or shuffle-joined if large)."""
    from riskframe.operators.encode import apply_target_encoder
    return apply_target_encoder(stream, encoder, cols)


def score_stream(stream: DataFrame, model) -> DataFrame:
    """Score a stream with a fitted model (stateless ``transform``)."""
    from riskframe.operators.model import score
    return score(model, stream)
