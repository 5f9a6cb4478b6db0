"""Best-fit packing of tokenised documents, planned on the histogram of lengths.

1. Each document is encoded (byte pairs, see ``bpe``), ends in ``END_ID`` and, if longer than a sequence,
   is cut into pieces of full length of which the first may be shorter.  A task
   numbers its pieces of each length; running counts over the tasks' blocks of
   pieces make that the rank of a piece among all of its length.
2. Best-fit decreasing is run over the histogram: lengths from long to short,
   each into the open sequences with the least room that suffices.  All open
   sequences with the same room are handled as one run, so the plan takes some
   thousand steps whatever the number of documents, and equals best fit over
   the single pieces.  A step places the ranks ``low`` to ``high`` of a length,
   ``per`` a sequence, from sequence ``first`` on, at ``at``.
3. Pieces take their slots by joining the plan on length and rank.

The plan is the only thing broadcast.  A length splits at most one run in
three and opens at most two, so at length L there are at most 3 (1024 - L) + 2
runs and the plan has at most 1.6 million rows (40 bytes each) for any input;
real histograms give a few thousand.

Defined results: null text counts as empty; an empty text is the end id alone;
rows that repeat a ``doc_id``, or have none, are documents of their own; pieces
of one length are alike to the plan, so which of them share a sequence follows
the order of the input; an empty table gives no rows.  No bound is set on a
text's length.  Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.prefix import running_totals
from riskframe.llm import bpe
from riskframe.llm import words as W
from riskframe.llm.chunks import ids_of, load
from riskframe.session import Scratch
from riskframe.sources.tables import read_table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
CAPACITY = 1024
BLOCK = 1024  # pieces of a length in a task that are ranked together
PIECES = "doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long, task int, nth long"
#: Fixed value: the splitting rule of the files that byte pairs alone can encode (see ``bpe``)
BY_WORDS = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_encoders: dict = {}
_ranks: dict = {}


def word_ranks(path: str) -> tuple | None:
    """Ranks of a tokenizer that splits by ``BY_WORDS``, else None."""
    if path not in _ranks:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        simple = file["normalizer"] is None and file["pre_tokenizer"] == BY_WORDS and not file["model"]["end_of_word_suffix"]
        _ranks[path] = bpe.ranks(path) if simple else None
    return _ranks[path]


def encoder(path: str, ranks: tuple | None):
    """A function from a list of texts to (ids of all, number of ids of each)."""
    if path not in _encoders:
        if ranks:
            words = bpe.encoding(ranks, public_tokenizers.PATTERN)

            def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
                lists = [words.encode_to_numpy(t, allowed_special="all") for t in texts]
                return np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))

            _encoders[path] = encode
        else:
            _encoders[path] = partial(ids_of, load(path))
    return _encoders[path]


def _cut(path: str, ranks, end_id: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode, task = encoder(path, ranks.value), TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)  # pieces of each length so far
    for batch in batches:
        for a, b, _, _ in W.slices(batch.column(1)):
            found, size = encode(batch.column(1)[a:b].fill_null("").to_pylist())
            ids = np.insert(found.astype(np.int32), np.cumsum(size), end_id)
            size = size + 1
            pieces = -(-size // capacity)
            of, piece = np.repeat(np.arange(len(size)), pieces), W.places(np.zeros(len(size), int), pieces)[1]
            first = size - (pieces - 1) * capacity
            length = np.where(piece == 0, first[of], capacity)
            start = np.where(piece == 0, 0, first[of] + (piece - 1) * capacity)
            order = np.argsort(length, kind="stable")
            kinds, count = np.unique(length[order], return_counts=True)
            nth = np.empty(len(order), np.int64)
            nth[order] = seen[length[order]] + W.places(np.zeros(len(kinds), int), count)[1]
            seen[kinds] += count
            ends = np.cumsum(length)
            data = memoryview(ids.astype("<u4", copy=False)).cast("B")
            crc = [zlib.crc32(data[4 * (z - n):4 * z]) for z, n in zip(ends.tolist(), length.tolist())]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[a:b].take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), lists,
                 pa.array(crc, pa.int64()), pa.array(np.full(len(of), task, np.int32)), pa.array(nth)],
                names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "task", "nth"])
    W.release()


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` of lengths: steps (length, low, high, per, first, at)."""
    open_: dict[int, list[tuple[int, int]]] = {}  # by room left: runs (first sequence, number of sequences)
    steps, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        room = length
        while left:
            while room < capacity and not open_.get(room):
                room += 1
            if room < capacity:
                first, n = open_[room].pop()
            else:  # nothing fits: open as many as the rest needs
                first, n = sequences, -(-left // (capacity // length))
                sequences += n
            per = room // length
            full = min(n, left // per)
            rest = min(left - full * per, per) if full < n else 0
            for k, each, begin in ((full, per, first), (1, rest, first + full)):
                if k and each:
                    steps.append((length, rank, rank + k * each, each, begin, capacity - room))
                    rank, left = rank + k * each, left - k * each
                    if room > each * length:
                        open_.setdefault(room - each * length, []).append((begin, k))
            used = full + (rest > 0)
            if used < n:
                open_.setdefault(room, []).append((first + used, n - used))
    return steps


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """A row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids, ids_crc32 (of the ids
    as little-endian uint32), sequence_id, offset."""
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    ranks = spark.sparkContext.broadcast(word_ranks(path))  # of the size of the vocabulary
    pieces = Scratch(spark, "packing").write(docs.select("doc_id", "text").mapInArrow(partial(_cut, path, ranks, end_id, capacity), PIECES))
    # a block is a key of bounded size, however many pieces of a length a task has
    pieces = pieces.withColumn("block", F.floor(F.col("nth") / BLOCK))
    counts = pieces.groupBy("task", "length", "block").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    before = running_totals(counts.withColumn("place", F.struct("task", "block")), ["length"], "place", ["n"])
    bases = before.select("task", "length", "block", (F.col("cum_n") - F.col("n")).alias("base"))
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    steps = plan({r["length"]: r["n"] for r in histogram}, capacity)
    slots = spark.createDataFrame(steps, "of long, low long, high long, per long, first long, at long")
    ranked = pieces.join(bases, ["task", "length", "block"]).withColumn("rank", F.col("base") + F.col("nth") % BLOCK)
    mine = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    # the plan's size is bounded by the capacity (see above)
    return ranked.join(F.broadcast(slots), mine).select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32", (F.col("first") + F.floor(nth / F.col("per"))).alias("sequence_id"),
        (F.col("at") + nth % F.col("per") * F.col("length")).alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids (at most the capacity), pieces (doc_id, piece, offset) in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return whole.select("sequence_id", F.flatten("parts.ids").alias("ids"),
                        F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"])).alias("pieces"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(read_table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
