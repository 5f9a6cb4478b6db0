"""Quality by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets.  Two
bucket distributions are estimated: of the whole corpus, and of target
documents (those labelled of good quality).  A document's log weight is the
sum over its n-grams of the log ratio of the two.  Adding Gumbel noise to the
log weights and taking the k largest samples k documents without replacement
in proportion to their weights.

The target model is fitted on at most ``MAX_TARGET`` labelled documents (those
with the least md5 of doc_id); the raw model counts all documents.  Counts are
added up in each task, so each sends BUCKETS rows at most, and the driver gets
BUCKETS sums.  The k largest are found by global ranks from range partitions.

The noise comes from a hash of doc_id and a seed, so reruns agree.

Defined results: null and empty texts have no n-grams and log weight 0; labels
that are null or of documents that don't exist are left out; without target
documents all log weights are 0 and the sample is uniform; ties go to the
smaller doc_id; rows that repeat a ``doc_id`` have the same noise and are
sampled one by one; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.ordered import running_sums
from riskframe.llm import words as W
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.tables import read_table

BUCKETS = 10_000
MAX_TARGET = 20_000
SHARE = 0.5  # of the documents are sampled
SEED = 23
SMOOTHING = 1.0
FIXED = 1 << 20  # log ratios are whole multiples of 1 / FIXED, so sums don't depend on their order


def ngram_buckets(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every word and every pair of neighbouring words."""
    parts = [W.grams(words, k) for k in (1, 2)]
    h = np.concatenate([p[0] for p in parts])
    row = np.searchsorted(words.first, np.concatenate([p[1] for p in parts]), "right") - 1
    return (h % np.uint64(BUCKETS)).astype(np.int64), row


def _count(targets, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        ids = batch.column(0)
        good = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), targets.value) & ids.is_valid().to_numpy(zero_copy_only=False)
        for a, b, data, offsets in W.slices(batch.column(1)):
            bucket, row = ngram_buckets(W.split_words(data, offsets, W.NOT_WORD))
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[a:b][row]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])


def _weigh(ratio, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in W.slices(batch.column(1)):
            words = W.split_words(data, offsets, W.NOT_WORD)
            bucket, row = ngram_buckets(words)
            sums = np.zeros(b - a, np.int64)
            np.add.at(sums, row, ratio.value[bucket])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[a:b], pa.array(np.bincount(row, minlength=b - a)), pa.array(sums / FIXED)],
                names=["doc_id", "n_ngrams", "log_weight"])
    W.release()


def fit(docs: DataFrame, good: DataFrame, max_target: int = MAX_TARGET) -> np.ndarray:
    """The log ratio of each bucket (times FIXED) from all ``docs`` and the doc_ids in ``good``."""
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    chosen = good.select("doc_id").where("doc_id is not null").distinct().orderBy(order, "doc_id").limit(max_target)
    targets = np.sort(np.array([r[0] for r in chosen.collect()], np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(targets)
    counts = docs.select("doc_id", "text").mapInArrow(partial(_count, shared), "bucket long, raw long, target long")
    found = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[found["bucket"].astype(int)], target[found["bucket"].astype(int)] = found["raw"], found["target"]
    if not target.any():
        return np.zeros(BUCKETS, np.int64)
    log = [np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS)) for c in (target, raw)]
    return np.rint((log[0] - log[1]) * FIXED).astype(np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise from a hash of ``doc_id``: 52 bits make a number strictly between 0 and 1."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f"-{seed}")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def resample(docs: DataFrame, good: DataFrame, share: float = SHARE, seed: int = SEED, max_target: int = MAX_TARGET) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_ngrams, log_weight, key (with noise), rank, selected."""
    ensure_checkpoint_dir(docs.sparkSession)
    ratio = docs.sparkSession.sparkContext.broadcast(fit(docs, good, max_target))
    weighed = docs.select("doc_id", "text").mapInArrow(partial(_weigh, ratio), "doc_id long, n_ngrams long, log_weight double")
    keyed = weighed.withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)).checkpoint(eager=True)
    k = round(share * keyed.count())
    ranked = running_sums(keyed, [F.col("key").desc(), F.col("doc_id").asc_nulls_last()], {}, row_number="rank")
    return ranked.withColumn("selected", F.col("rank") <= k)


def op4_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return resample(read_table(spark, sf_dir, "documents"), good)
