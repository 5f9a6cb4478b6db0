"""Benchmark passages in documents, found by winnowing.

Every run of ``K`` words has a hash; of each ``SLIDE`` neighbouring hashes the
least (of equals the last) is a fingerprint.  A shared run of K + SLIDE - 1
words or more has the same hashes on both sides, so it shares a fingerprint at
the same place of the run.  With K + SLIDE - 1 = ``WINDOW`` words, every
occurrence of a benchmark window is found:

1. one scan of the documents fingerprints whole texts and keeps the
   fingerprints that a bitmap of fixed size says the benchmark may have;
2. these join the benchmark's fingerprints;
3. each hit is extended on both sides: of the SLIDE windows that hold the
   fingerprint, those that are equal in document and item are occurrences;
4. a row's occurrences give its hit words and its items.

Rows are numbered in the checkpointed scan and judged one by one under that
number; a ``doc_id`` only goes along.

Items of fewer words than a window are one window of their own length; their
hash is looked up for the runs of that length in the documents.

Words are compared by 64-bit hashes of their bytes.  The bitmap is a first
sieve; whatever it lets through by chance is settled by the join.  Its size,
``BITS`` / 8 bytes, doesn't grow with either table.

Defined results: null and empty texts have no words, no hits, and the hash of
an empty list; an item without words matches nothing; items that repeat an
``item_id`` count once; rows that repeat a ``doc_id`` or have none are judged
each by its own text; empty tables give no rows or no hits.  Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import words as W
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.tables import read_table

WINDOW = 13
SLIDE = 6
K = WINDOW - SLIDE + 1
BITS = 1 << 24
SHARE = 20  # contaminated: at least one word in so many is hit
#: kinds of fingerprint: 0 for a run of K words with its windows, n > 0 for a whole item of n words
PRINT = "kind int, print long, at int, windows array<long>"


def _signed(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64).view(np.int64)


def _bit(print_: np.ndarray, kind: int) -> np.ndarray:
    return W.mix(print_ ^ np.uint64(kind)) % np.uint64(BITS)


def fingerprints(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the winnowed runs of K words in rows of WINDOW words or more."""
    h, place = W.grams(words, K)
    if len(h) < SLIDE:
        return h[:0], place[:0]
    n = len(h) - SLIDE + 1
    together = np.flatnonzero(place[SLIDE - 1:] == place[:n] + SLIDE - 1)
    # runs of one row are neighbours; those of different rows are K - 1 places apart
    best = h[together].copy()
    at = together.copy()
    for j in range(1, SLIDE):
        less = h[together + j] <= best
        best[less] = h[together + j][less]
        at[less] = together[less] + j
    at = np.unique(at)
    return h[at], place[at]


def _windows(full: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each place the hashes of the SLIDE windows that start at, one before, ... it; 0 where there is none."""
    back = places[:, None] - np.arange(SLIDE)
    inside = (back >= 0) & (back < len(full))
    return np.where(inside, full[np.where(inside, back, 0)] if len(full) else 0, 0)


def _full(words: W.Words) -> np.ndarray:
    """By place the hash of the WINDOW words from there; 0 where a row has fewer left."""
    full = np.zeros(len(words.hashes), np.uint64)
    h, place = W.grams(words, WINDOW)
    full[place] = h | np.uint64(1)
    return full


def _rows(lists: list[list], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(lists, types)], names=names)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Benchmark: item_id, kind, print, at, windows (1-based at in the item's words)."""
    for batch in batches:
        for a, b, data, offsets in W.slices(batch.column(1)):
            words = W.split_words(data, offsets, W.NOT_WORD)
            full, (h, place) = _full(words), fingerprints(words)
            found = _windows(full, place)
            ids, out = batch.column(0)[a:b].to_pylist(), [[] for _ in range(5)]
            row = np.searchsorted(words.first, place, "right") - 1
            for i in range(len(h)):
                for col, x in zip(out, (ids[row[i]], 0, int(_signed(h[i:i + 1])[0]), int(place[i]), _signed(found[i]))):
                    col.append(x)
            for r in np.flatnonzero((0 < np.diff(words.first)) & (np.diff(words.first) < WINDOW)):
                n = int(words.first[r + 1] - words.first[r])
                one = np.array([W.whole(words, r)], np.uint64)
                for col, x in zip(out, (ids[r], n, int(_signed(one)[0]), 0, None)):
                    col.append(x)
            yield _rows(out, ["item_id", "kind", "print", "at", "windows"],
                        [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64())])


def _scan(sieve: np.ndarray, lengths: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents: doc_id, text_hash, n_words, hits (kind, print, at, windows of those that pass the sieve)."""
    for batch in batches:
        for a, b, data, offsets in W.slices(batch.column(1)):
            words = W.split_words(data, offsets, W.NOT_WORD)
            kinds, prints, places, found = [], [], [], []
            h, place = fingerprints(words)
            passed = np.flatnonzero(sieve[_bit(h, 0)])
            if len(passed):
                kinds.append(np.zeros(len(passed), np.int32))
                prints.append(h[passed])
                places.append(place[passed])
                found.append(_windows(_full(words), place[passed]))
            for n in lengths:
                h, place = W.grams(words, n)
                passed = np.flatnonzero(sieve[_bit(h, n)])
                kinds.append(np.full(len(passed), n, np.int32))
                prints.append(h[passed])
                places.append(place[passed])
                found.append(np.zeros((len(passed), SLIDE), np.uint64))
            kind, print_, place = (np.concatenate(x) if x else np.zeros(0, t)
                                   for x, t in ((kinds, np.int32), (prints, np.uint64), (places, np.int64)))
            windows = np.concatenate(found) if found else np.zeros((0, SLIDE), np.uint64)
            row = np.searchsorted(words.first, place, "right") - 1
            order = np.argsort(row, kind="stable")
            at = (place - words.first[row])[order].astype(np.int32)
            hits = pa.StructArray.from_arrays(
                [pa.array(kind[order]), pa.array(_signed(print_[order])), pa.array(at),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1, dtype=np.int32) * SLIDE),
                                          pa.array(_signed(windows[order].reshape(-1))))],
                names=["kind", "print", "at", "windows"])
            bounds = np.searchsorted(row[order], np.arange(b - a + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[a:b], batch.column(2)[a:b], pa.array(np.diff(words.first)),
                 pa.ListArray.from_arrays(pa.array(bounds), hits)],
                names=["doc_id", "text_hash", "n_words", "hits"])
    W.release()


def _sieve(index: DataFrame) -> tuple[np.ndarray, list[int]]:
    """Bitmap of the index's fingerprints (fixed size) and the lengths of its short items (1 to 12)."""
    bits = index.select("kind", "print").mapInArrow(_set_bits, "word int, bits long")
    merged = bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(BITS // 64, np.uint64)
    words[merged["word"].to_numpy()] = merged["bits"].to_numpy().astype(np.int64).view(np.uint64)
    lengths = sorted(r[0] for r in index.where("kind > 0").select("kind").distinct().collect())
    return words, lengths


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = np.zeros(BITS // 64, np.uint64)
    for batch in batches:
        kind, print_ = (batch.column(i).to_numpy() for i in (0, 1))
        bit = W.mix(print_.view(np.uint64) ^ kind.astype(np.uint64)) % np.uint64(BITS)
        np.bitwise_or.at(words, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    used = np.flatnonzero(words)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(_signed(words[used]))], names=["word", "bits"])


class _Scan:
    """The scan with its sieve as a broadcast variable, unpacked once per Python worker."""

    def __init__(self, sieve, lengths: list[int]):
        self.sieve, self.lengths = sieve, lengths

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(self.sieve.value.view(np.uint8), bitorder="little").view(bool)
        return _scan(flags, self.lengths, batches)


def index_benchmark(benchmark: DataFrame) -> DataFrame:
    """The benchmark's fingerprints: item_id, kind, print, windows."""
    ensure_checkpoint_dir(benchmark.sparkSession)
    index = benchmark.select("item_id", "text").mapInArrow(_index, f"item_id long, {PRINT}")
    return index.drop("at").distinct().checkpoint(eager=True)


def text_hash(text: str) -> Column:
    return F.sha2(text, 256).alias("text_hash")


def occurrences(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, occurrences): number (row), doc_id, text_hash and n_words of every row, and the
    (row, item_id, first word, words) of all windows of items in rows."""
    spark = docs.sparkSession
    index = index_benchmark(benchmark)
    words, lengths = _sieve(index)
    scan = _Scan(spark.sparkContext.broadcast(words), lengths)
    scanned = docs.select("doc_id", "text", text_hash("text")).mapInArrow(
        scan, "doc_id long, text_hash string, n_words long, hits array<struct<kind:int,print:long,at:int,windows:array<long>>>")
    scanned = scanned.withColumn("row", F.monotonically_increasing_id()).checkpoint(eager=True)
    hits = scanned.select("row", F.inline("hits"))
    of_item = index.withColumnRenamed("windows", "item_windows")
    joined = hits.join(of_item, ["kind", "print"])
    same = F.array_compact(F.transform(F.arrays_zip("windows", "item_windows"), lambda w, j: F.when(
        (w["windows"] == w["item_windows"]) & (w["windows"] != 0), F.col("at") - j)))
    starts = F.when(F.col("kind") > 0, F.array(F.col("at"))).otherwise(same)
    length = F.when(F.col("kind") > 0, F.col("kind")).otherwise(F.lit(WINDOW))
    found = joined.select("row", "item_id", length.alias("words"), F.explode(starts).alias("first"))
    return scanned.select("row", "doc_id", "text_hash", "n_words"), found


def covered(spans: Column) -> Column:
    """Places covered by an array of (first, end) structs, which may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end"))
    return F.aggregate(F.array_sort(spans), start, lambda s, x: F.struct(
        (s["n"] + F.greatest(x["end"] - F.greatest(x["first"], s["end"]), F.lit(0))).alias("n"),
        F.greatest(s["end"], x["end"]).alias("end")), lambda s: s["n"])


def judge_rows(docs: DataFrame, benchmark: DataFrame, share: int = SHARE) -> DataFrame:
    """One row per row of ``docs``: row (a number), doc_id, text_hash, n_words, n_hit, n_items, items (sorted
    item_ids as text), spans (first word and end of each occurrence), contaminated."""
    rows, found = occurrences(docs, benchmark)
    span = F.struct(F.col("first"), (F.col("first") + F.col("words")).alias("end"))
    per_row = found.groupBy("row").agg(F.collect_set(span).alias("spans"),
                                       F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    none = F.array().cast("array<string>")
    out = rows.join(per_row, "row", "left").withColumns({
        "n_hit": F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long"), "items": F.coalesce("items", none)})
    return out.select("row", "doc_id", "text_hash", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans",
                      ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def judge(docs: DataFrame, benchmark: DataFrame, share: int = SHARE) -> DataFrame:
    """``judge_rows`` summed up by doc_id: doc_id, n_words, n_hit, n_items, items, contaminated (whether any of its rows is)."""
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))))
    by_id = judge_rows(docs, benchmark, share).groupBy("doc_id").agg(
        F.sum("n_words").alias("n_words"), F.sum("n_hit").alias("n_hit"), items.alias("items"), F.bool_or("contaminated").alias("contaminated"))
    return by_id.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated; same columns."""
    # the verdict depends on the text alone, so rows of equal doc_id and text share it
    gone = judge_rows(docs, benchmark, share).where("contaminated").select(F.col("doc_id").alias("_gone"), "text_hash").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("_id"),
                       text_hash("text").alias("_hash"))
    left = rows.join(gone, F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_hash") == F.col("text_hash")), "left_anti")
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_rows(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS t
  FROM items, LATERAL (SELECT unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM words, lengths, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) WHERE len(w) >= n),
found AS (SELECT d.doc_id, d.i, d.n, m.item_id FROM doc_windows d JOIN item_windows m ON d.n = m.n AND d.t = m.t),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
of_doc AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM found GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w.w), false) AS contaminated
FROM words w LEFT JOIN hit USING (doc_id) LEFT JOIN of_doc USING (doc_id)
"""
