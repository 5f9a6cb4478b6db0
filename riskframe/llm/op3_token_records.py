"""Token ids in length-delimited binary records with checksums and a separate offset index.

A shard is a run of records in ascending ``doc_id`` order.  A record is

    uint64  payload length            uint32  masked CRC-32 of those 8 bytes
    payload                           uint32  masked CRC-32 of the payload
    0x0A    end mark

all little-endian.  The payload is int64 doc_id, uint8 bytes per id (2 or 4),
then the ids.  Masking (rotate right by 15 bits, add ``MASK``) keeps the
checksum of data that itself holds checksums from being degenerate.

Spark writes the shards through its own file writer (the end mark is the
writer's line separator, a record is passed on as opaque bytes), so any
Hadoop file system works, lost tasks are retried and a half-written shard is
never committed.  The index, a Parquet table beside the shards, holds for
each document its shard, byte offset, record length, ids before it in the
whole corpus, and number of ids; readers in shuffled order use it.

Defined results: null text counts as empty; an empty text is one record with
the end id alone; rows that repeat a ``doc_id`` are records of their own, in
order of a hash of their texts; a null ``doc_id`` sorts first and is stored as the
smallest int64; an empty table gives an index without rows.  Other columns
are not read.  No bound is set on a text's length, but that a record, like a
shard when it's read back, must fit into 2 GB.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.functions.ordered import shuffle_partitions
from riskframe.llm import bpe
from riskframe.llm import words as W
from riskframe.llm.chunks import ChunkEncoder, ids_of, load
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.tables import read_table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
MASK = 0xA282EAD8
NO_ID = -(1 << 63)
SHARD_BYTES = 64 << 20  # text in a shard, about
_HEAD, _FOOT, _DOC = struct.Struct("<QI"), struct.Struct("<Ic"), struct.Struct("<qB")
_encoders: dict = {}
_ranks: dict = {}


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record, but for the end mark."""
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes, at: int) -> tuple[memoryview, int]:
    """The payload of the record at ``at`` and the place of the next one; ValueError if it's damaged."""
    length, check = _HEAD.unpack_from(data, at)
    end = at + _HEAD.size + length
    if check != masked(data[at:at + 8]) or end + _FOOT.size > len(data):
        raise ValueError(f"record at byte {at}: damaged length")
    payload = memoryview(data)[at + _HEAD.size:end]
    check, mark = _FOOT.unpack_from(data, end)
    if check != masked(payload) or mark != b"\n":
        raise ValueError(f"record at byte {at}: damaged payload")
    return payload, end + _FOOT.size


#: The normalisation and the splitting rule that chunks and the short cut for plain words rely on
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


class Learner:
    """Ids of an array of chunks.  White space is no token.  A chunk of letters below U+0100 is one word to the
    tokenizer, in lower case; a comma or full stop after it is a word of its own.  Such words are encoded all at
    once by their byte pairs alone (see ``bpe``), other chunks by all the tokenizer's steps (a test compares both)."""

    def __init__(self, tokenizer, words):
        self.tokenizer = tokenizer
        self.words = bpe.encoding(words, r"[^\x00]+\x00", special=False)
        self.last = np.zeros(max(words[0].values()) + 1, bool)  # ids that end a word
        self.last[[i for token, i in words[0].items() if len(token) > 1 and token.endswith(bpe.END)]] = True
        self.points = pa.array([",", "."])
        self.point_ids = np.array([words[0][p.encode() + bpe.END] for p in (",", ".")], np.uint32)

    def __call__(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
        low = np.maximum.reduceat(np.frombuffer(chunks.buffers()[2], np.uint8)[:offsets[-1]], offsets[:-1]) < 0xC4
        texts = chunks.cast(pa.large_string())
        words = pc.utf8_lower(pc.utf8_trim(texts, " \t\n\v\f\r"))
        ending = pc.utf8_slice_codeunits(words, -1)
        pointed = pc.is_in(ending, value_set=self.points.cast(pa.large_string()))
        words = pc.if_else(pointed, pc.utf8_slice_codeunits(words, 0, -1), words)
        plain = low & pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        others = self._other(texts.filter(pa.array(~plain)).to_pylist())
        known = self._plain(words.filter(pa.array(plain)), pointed.filter(pa.array(plain)), ending.filter(pa.array(plain)))
        sizes = np.empty(len(chunks), np.int64)
        sizes[plain], sizes[~plain] = known[1], others[1]
        starts = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        for mine, (ids, n) in ((plain, known), (~plain, others)):
            out[W.places(starts[mine], n)[0]] = ids
        return out, sizes

    def _other(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return ids_of(self.tokenizer, texts) if texts else (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _plain(self, words: pa.Array, pointed: pa.Array, ending: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids = self.words.encode_to_numpy("\0".join(words.to_pylist()) + "\0", disallowed_special=())
        sizes = np.diff(np.flatnonzero(self.last[ids]) + 1, prepend=0)
        pointed = pointed.to_numpy(zero_copy_only=False)
        whole = sizes + pointed  # with the point
        ends = np.cumsum(whole)
        out = np.empty(int(ends[-1]), np.uint32)
        out[W.places(ends - whole, sizes)[0]] = ids
        out[ends[pointed] - 1] = self.point_ids[(ending.filter(pa.array(pointed)).to_numpy(zero_copy_only=False) == ".").astype(int)]
        return out, whole


def word_ranks(path: str) -> tuple | None:
    """Ranks of a tokenizer with ``RULES`` whose words can be encoded by their byte pairs, else None."""
    if path not in _ranks:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        _ranks[path] = bpe.ranks(path) if all(file[k] == v for k, v in RULES.items()) and file["model"]["end_of_word_suffix"] else None
        del file
        W.tidy()
    return _ranks[path]


def encoder(path: str, words: tuple | None) -> ChunkEncoder:
    """Of a tokenizer file and its ``word_ranks``; without these, whole texts are encoded instead of chunks."""
    if path not in _encoders:
        tokenizer = load(path)
        learn = Learner(tokenizer, words) if words else lambda texts: ids_of(tokenizer, texts.cast(pa.large_string()).to_pylist())
        dtype = np.uint16 if tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        _encoders[path] = ChunkEncoder(learn, dtype, END_ID, whole=not words)
    return _encoders[path]


def _encode(path: str, words, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunked = encoder(path, words.value)
    width = chunked.dtype.itemsize
    for batch in batches:
        for a, b, ids, first in chunked.slices(batch.column(1)):
            data, ends = ids.astype(chunked.dtype.newbyteorder("<"), copy=False).tobytes(), (first * width).tolist()
            rows = [frame(_DOC.pack(NO_ID if i is None else i, width) + data[x:y])
                    for i, x, y in zip(batch.column(0)[a:b].to_pylist(), ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])
    W.release()


def write_records(docs: DataFrame, out: str, tokenizer: str | None = None, shards: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) into ``out``/records, one file per shard, ascending doc_id.

    Without a number of shards there are as many as shuffle partitions, or more if that keeps their text near
    ``SHARD_BYTES``.  Rows that share a doc_id, however many, spread over several shards."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    if shards is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(shuffle_partitions(docs), -(-size // SHARD_BYTES))
    order = ["doc_id", "_text", "_row"]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"), F.monotonically_increasing_id().alias("_row"))
    # the range bounds come from a sample of the keys; texts are encoded after the shuffle, once
    ranged = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    words = docs.sparkSession.sparkContext.broadcast(word_ranks(path))  # of the size of the vocabulary
    (ranged.mapInArrow(partial(_encode, path, words), "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\n").mode("overwrite").text(f"{out}/records"))


def _scan(with_ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            data, at, before = memoryview(content.as_buffer()), 0, 0  # in place, not a copy
            shard = path.as_py().rpartition("/")[2]
            while at < len(data):
                cols: list[list] = [[] for _ in range(8)]
                size = 0
                while at < len(data) and size < 1 << 20:  # about a million ids per batch
                    payload, end = unframe(data, at)
                    doc_id, width = _DOC.unpack_from(payload)
                    ids = np.frombuffer(payload, f"<u{width}", offset=_DOC.size).astype("<u4")
                    row = (shard, None if doc_id == NO_ID else doc_id, at, end - at, before, len(ids), zlib.crc32(ids), ids.astype(np.int32) if with_ids else None)
                    for col, value in zip(cols, row):
                        col.append(value)
                    at, before, size = end, before + len(ids), size + len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.string(), *[pa.int64()] * 6, pa.list_(pa.int32())))],
                    names=["shard", "doc_id", "offset", "length", "before", "n_tokens", "ids_crc32", "ids"])


def scan_records(spark: SparkSession, out: str, with_ids: bool = True) -> DataFrame:
    """Every record of the shards, checked: shard, doc_id, offset, length, before (ids before it in
    its shard), n_tokens, ids_crc32 (of the ids as uint32), ids (array of int; null unless asked for)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{out}/records")
    return files.select("path", "content").mapInArrow(
        partial(_scan, with_ids), "shard string, doc_id long, offset long, length long, before long, n_tokens long, ids_crc32 long, ids array<int>")


def write_index(spark: SparkSession, out: str) -> DataFrame:
    """Read all shards back and write the offset index to ``out``/index; returns it."""
    found = scan_records(spark, out, with_ids=False).drop("ids")
    ensure_checkpoint_dir(spark)
    found = found.checkpoint(eager=True)
    # one row per shard (a file of SHARD_BYTES of text or more), in the order of the numbers in their names
    number = F.regexp_extract("shard", r"^part-(\d+)", 1).cast("long")
    totals = found.groupBy("shard").agg(F.sum("n_tokens").alias("ids")).withColumn("number", number)
    earlier = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    index = found.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "shard", "offset", "length")
    index.write.mode("overwrite").parquet(f"{out}/index")
    return spark.read.parquet(f"{out}/index")


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, places in zip(batch.column(0), batch.column(1)):
            data, got = memoryview(content.as_buffer()), []
            for at in places.as_py():
                payload, _ = unframe(data, at)
                doc_id, width = _DOC.unpack_from(payload)
                got.append((None if doc_id == NO_ID else doc_id, np.frombuffer(payload, f"<u{width}", offset=_DOC.size).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()),
                                              pa.array([g[1] for g in got], pa.list_(pa.int32()))], names=["doc_id", "ids"])


def read_documents(spark: SparkSession, out: str, doc_ids: DataFrame) -> DataFrame:
    """The ids (doc_id, ids) of the documents in ``doc_ids`` (a column doc_id), in any order: the
    index names their places, and only the records there are decoded."""
    index = spark.read.parquet(f"{out}/index")
    wanted = index.join(doc_ids.select("doc_id").distinct(), "doc_id").groupBy("shard").agg(F.collect_list("offset").alias("places"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{out}/records")
    opened = files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content").join(wanted, "shard")
    return opened.select("content", "places").mapInArrow(_pick, "doc_id long, ids array<int>")


def output_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/token-records-{uuid.uuid4().hex}"


def encode_and_read_back(docs: DataFrame, out: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write records and index of ``docs``, and return the index as read back."""
    spark = docs.sparkSession
    out = out or output_folder(spark)
    write_records(docs, out, tokenizer)
    return write_index(spark, out)


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read_back(read_table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")
