"""Toxicity by subword-bag embeddings: averaged vectors into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of the word itself and of its
character n-grams (with word-end marks), all hashed into ``BUCKETS`` rows, so
words never seen share the vectors of the n-grams they have.  A bag is a run
of ``BAG`` words; its averaged vector goes into a linear softmax over two
classes.  A document is as toxic as its worst bag, so one insult isn't
averaged away in a long text: all bags of the whole text are scored.

Training sees at most ``MAX_TOXIC`` + ``MAX_OTHER`` labelled documents (those
with the least md5 of doc_id) of at most ``MAX_TEXT`` bytes each and of
``MAX_BYTES`` together, whatever the size of the table.  It runs in one task,
which hands on the fitted model.  It first takes random bags of each document,
then each document's worst bag under the model so far.  The fitted model is one
number per bucket, since the softmax of a mean of vectors needs only each
vector's difference of class scores.

Defined results: null and empty texts are a bag without words, scored by the
bias alone; labels that are null, or of documents that don't exist, are left
out, and of several labels of a document the largest counts; with labels of
one class or none, every score is that class's label (0 without labels); rows
that repeat a ``doc_id`` are scored one by one; empty tables give no rows.
Labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm import words as W
from riskframe.sources.tables import read_table

BUCKETS = 1 << 20
DIM = 8
GRAMS = (3, 4, 5, 6)
BAG = 16
MAX_TOXIC, MAX_OTHER = 2000, 6000
MAX_TEXT, MAX_BYTES = 1 << 20, 48 << 20  # bytes of a text, and of all texts, of the training sample
FOLDS = 5  # rows with crc32(doc_id as text) mod FOLDS = 0 are held out
EPOCHS, STEPS, BATCH, RATE = 12, 384, 256, 0.15  # so many rounds, and batches, at least
RANDOM = 0.25  # of the rounds take random bags
AT_ONCE = 1 << 18  # words whose bags are looked at together
FIXED = 1 << 24  # word scores are summed as whole multiples of 1 / FIXED, so sums don't depend on their order
_WORD = np.ones(128, bool)
_WORD[:] = [chr(c).isalnum() for c in range(128)]


class Bags:
    """The words of rows: number of each word, first word of each row; by number, words' hashes and subword buckets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, known: np.ndarray | None = None):
        """Words whose hashes are ``known`` (sorted) get no subword buckets."""
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]  # row offsets in characters
        ascii_ = codes < 128
        upper = (codes >= 65) & (codes <= 90)
        codes[upper] += np.uint64(32)
        inside = ~ascii_
        inside[ascii_] = _WORD[codes[ascii_]]
        starts, ends, self.first = W.word_bounds(inside, chars)
        lengths = ends - starts
        place, number = W.places(starts, lengths)
        hashed = W.mix(codes[place] + np.uint64(1)) * W.powers(int(lengths.max(initial=1)))[number]
        sums = np.add.reduceat(hashed, np.cumsum(lengths) - lengths) if len(starts) else np.zeros(0, np.uint64)
        self.hashes, at, self.word = np.unique(W.mix(sums), return_index=True, return_inverse=True)
        if known is not None:
            self.new = np.flatnonzero(~np.isin(self.hashes, known, assume_unique=True))
            at = at[self.new]
        self.buckets, self.bounds = subwords(codes, starts[at], lengths[at])

    @classmethod
    def of_texts(cls, texts: pa.Array) -> Bags:
        """All rows of ``texts``, read in slices; each distinct word's buckets are held once."""
        parts, known, rows, buckets, sizes, new = [], np.zeros(0, np.uint64), [], [], [], []
        for _, _, data, offsets in W.slices(texts):
            part = cls(data, offsets, known)
            parts.append(part.hashes[part.word])
            rows.append(np.diff(part.first))
            buckets.append(part.buckets)
            sizes.append(np.diff(part.bounds))
            new.append(part.hashes[part.new])
            known = np.union1d(known, new[-1])
        out = cls.__new__(cls)
        out.hashes = np.concatenate(new)  # words are numbered as they were met
        order = np.argsort(out.hashes)
        out.first = np.concatenate([[0], np.cumsum(np.concatenate(rows))])
        out.word = np.concatenate([order[np.searchsorted(known, p)].astype(np.int32) for p in parts])
        out.buckets = np.concatenate(buckets)
        out.bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return out


def subwords(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at_once: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its n-grams: those of word i are buckets[bounds[i]:bounds[i + 1]]."""
    parts = [_subwords(codes, starts[i:i + at_once], lengths[i:i + at_once]) for i in range(0, len(starts), at_once)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]))])


def _subwords(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(starts)
    size = lengths + 2  # with a mark before and after
    begin = np.cumsum(size) - size
    marked = np.empty(int(size.sum()), np.uint64)
    marked[begin], marked[begin + size - 1] = ord("<"), ord(">")
    place, number = W.places(starts, lengths)
    marked[W.places(begin + 1, lengths)[0]] = codes[place]
    marked = W.mix(marked)
    whole = np.add.reduceat(marked * W.powers(int(size.max()))[W.places(begin, size)[1]], begin)
    owner, found = [np.arange(n)], [W.mix(whole)]
    left = np.repeat(begin + size, size) - np.arange(len(marked))  # characters from a place to its word's end
    of = np.repeat(np.arange(n), size)
    for k in GRAMS:
        at = np.flatnonzero(left >= k)
        total = np.full(len(at), k, np.uint64)
        for j in range(k):
            total += marked[at + j] * W.powers(16)[j + 8]
        owner.append(of[at])
        found.append(W.mix(total))
    owner, found = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return (found[order] % np.uint64(BUCKETS)).astype(np.int32), np.bincount(owner, minlength=n)


def row_worst(scores: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By row: (largest mean of BAG neighbouring scores, first word and end of that bag); 0 for rows without words."""
    n = np.diff(first)
    if len(scores) > AT_ONCE and len(n) > 1:  # in runs of rows, to keep the working arrays small
        cut = max(1, min(len(n) - 1, int(np.searchsorted(first, len(scores) // 2))))
        parts = [row_worst(scores[first[a]:first[b]], first[a:b + 1] - first[a]) for a, b in ((0, cut), (cut, len(n)))]
        (x, at, end), (y, at_2, end_2) = parts
        return np.concatenate([x, y]), np.concatenate([at, at_2 + first[cut]]), np.concatenate([end, end_2 + first[cut]])
    total = np.concatenate([[0], np.cumsum(scores)])
    width = np.minimum(n, BAG)
    bags = np.where(n > 0, n - width + 1, 0)
    rows = np.repeat(np.arange(len(n)), bags)
    start = W.places(first[:-1], bags)[0]
    mean = (total[start + width[rows]] - total[start]) / np.maximum(width[rows], 1)
    best, at = np.zeros(len(n)), first[:-1].copy()
    if len(mean):
        full = np.flatnonzero(bags)
        begins = (np.cumsum(bags) - bags)[full]
        best[full] = np.maximum.reduceat(mean, begins)
        top = np.flatnonzero(mean == best[rows])[::-1]
        at[rows[top]] = start[top]  # the first of equals is written last
    return best, at, at + width


class Model:
    """One number per bucket and a bias: the softmax's difference of class scores."""

    def __init__(self, buckets: np.ndarray, bias: float):
        self.buckets, self.bias = buckets, bias

    def word_scores(self, bags: Bags) -> np.ndarray:
        """Score of each distinct word, as whole multiples of 1 / FIXED."""
        if len(bags.bounds) < 2:
            return np.zeros(0, np.int64)
        parts = []
        for low in range(0, len(bags.bounds) - 1, AT_ONCE // 16):
            bounds = bags.bounds[low:low + AT_ONCE // 16 + 1]
            sums = np.add.reduceat(self.buckets[bags.buckets[bounds[0]:bounds[-1]]], bounds[:-1] - bounds[0], dtype=np.float64)
            parts.append(np.rint(sums / np.diff(bounds) * FIXED).astype(np.int64))
        return np.concatenate(parts)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        bags = Bags(data, offsets)
        worst, _, _ = row_worst(self.word_scores(bags)[bags.word], bags.first)
        return 1 / (1 + np.exp(-np.clip(worst / FIXED + self.bias, -60, 60)))


def _sums(group: np.ndarray, rows: np.ndarray, groups: int) -> np.ndarray:
    return np.stack([np.bincount(group, column, groups) for column in rows.T], 1).astype(np.float32)


def train(texts: pa.Array, toxic: np.ndarray, seed: int = 11) -> Model:
    """Fit embeddings and softmax jointly by Adagrad on bags of the texts."""
    toxic = np.asarray(toxic).astype(int)
    if not len(toxic) or toxic.min() == toxic.max():
        return Model(np.zeros(BUCKETS, np.float32), 60.0 if len(toxic) and toxic[0] else -60.0)
    rng = np.random.default_rng(seed)
    bags = Bags.of_texts(texts)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    softmax, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    grown = [np.full((BUCKETS, 1), 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)]
    n = np.diff(bags.first)
    rows = np.flatnonzero(n)
    counts = np.bincount(toxic[rows], minlength=2)
    weight = (len(rows) / (2 * np.maximum(counts, 1)))[toxic]  # both classes weigh the same

    def now() -> Model:
        return Model(vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))

    batches = -(-len(rows) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // max(1, batches)))
    for epoch in range(epochs if len(rows) else 0):
        width = np.minimum(n, BAG)
        if epoch < RANDOM * epochs:
            at = bags.first[:-1] + (rng.random(len(n)) * (n - width + 1)).astype(np.int64)
        else:
            _, at, _ = row_worst(now().word_scores(bags)[bags.word], bags.first)
        for batch in np.array_split(rng.permutation(rows), batches):
            place, _ = W.places(at[batch], width[batch])
            bag = np.repeat(np.arange(len(batch)), width[batch])
            word, inverse = np.unique(bags.word[place], return_inverse=True)
            size = np.diff(bags.bounds)[word]
            bucket = bags.buckets[W.places(bags.bounds[word], size)[0]]
            ends = np.cumsum(size) - size
            of_word = np.add.reduceat(vectors[bucket], ends) / size[:, None]
            share = (1 / width[batch])[bag].astype(np.float32)
            mean = np.add.reduceat(of_word[inverse] * share[:, None], np.cumsum(width[batch]) - width[batch])
            raised = mean @ softmax + bias
            p = np.exp(raised - raised.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), toxic[batch]] -= 1
            d = (p * (weight[batch] / len(batch))[:, None]).astype(np.float32)
            steps = mean.T @ d, d.sum(0)
            to_mean = d @ softmax.T
            to_word = _sums(inverse, to_mean[bag] * share[:, None], len(word))
            used, where = np.unique(bucket, return_inverse=True)
            to_bucket = _sums(where, np.repeat(to_word / size[:, None], size, axis=0), len(used))
            grown[0][used] += (to_bucket ** 2).mean(1, keepdims=True)
            vectors[used] -= RATE * to_bucket / np.sqrt(grown[0][used])
            for x, g, s in zip((softmax, bias), grown[1:], steps):
                g += s ** 2
                x -= RATE * s / np.sqrt(g)
    return now()


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches, pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("toxic", pa.int32())])).sort_by("doc_id")
    model = train(table.column("text").combine_chunks(), table.column("toxic").to_numpy() == 1)
    yield pa.RecordBatch.from_arrays([pa.array([model.buckets.astype("<f4").tobytes()], pa.binary()), pa.array([model.bias])],
                                     names=["buckets", "bias"])
    W.release()


def sample(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_other: int = MAX_OTHER,
           max_bytes: int = MAX_BYTES) -> DataFrame:
    """(doc_id, text, toxic) of the bounded training sample: labelled documents that aren't held out."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    known = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(sizes, "doc_id")
    known = known.groupBy("doc_id", "toxic").agg(F.max("size").alias("size")).where(F.col("size") <= MAX_TEXT)
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    chosen = (known.where("toxic = 1").orderBy(order, "doc_id").limit(max_toxic)
              .unionByName(known.where("toxic <> 1").orderBy(order, "doc_id").limit(max_other)))
    # at most max_toxic + max_other rows without their texts
    chosen = chosen.withColumn("bytes", F.sum("size").over(Window.orderBy(order, "doc_id"))).where(F.col("bytes") <= max_bytes)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # of rows that share a doc_id the greatest of the longest texts
    return texts.groupBy("doc_id", "toxic").agg(F.max_by("text", F.struct(F.octet_length("text"), "text")).alias("text")).select(
        "doc_id", "text", F.col("toxic").cast("int").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_other: int = MAX_OTHER, max_bytes: int = MAX_BYTES) -> Model:
    """Train on a bounded sample of the labelled documents, in one task; only the model reaches the driver."""
    rows = sample(docs, labels, max_toxic, max_other, max_bytes).repartition(1)
    fitted = rows.mapInArrow(_train, "buckets binary, bias double").first()
    W.tidy()
    if fitted is None:
        return Model(np.zeros(BUCKETS, np.float32), -60.0)
    return Model(np.frombuffer(fitted["buckets"], "<f4").astype(np.float32, copy=False), fitted["bias"])


def _score(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.schema.get_field_index("_text")
        for a, b, data, offsets in W.slices(batch.column(text)):
            rest = [batch.column(i)[a:b] for i in range(batch.num_columns) if i != text]
            scores = model.value.scores(data, offsets)
            yield pa.RecordBatch.from_arrays([*rest, pa.array(scores)], names=[*(n for n in batch.schema.names if n != "_text"), "score"])
    W.release()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the toxicity score of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(partial(_score, shared), "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose texts score below ``threshold``, with the same columns; one scan, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("_text"))
    scored = rows.mapInArrow(partial(_score, shared), f"row {rows.schema['row'].dataType.simpleString()}, score double")
    return scored.where(F.col("score") < threshold).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
