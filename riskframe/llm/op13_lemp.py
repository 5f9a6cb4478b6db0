"""Hard negatives by LEMP-style coordinate pruning: length buckets, sorted coordinate lists, exact verification.

Vectors are range-split by label and length, longest first, into buckets of
bounded size (copies of one vector spread over several).  To find the products
<q, p> >= t of an anchor q in a bucket whose longest vector has length l, only
directions with a cosine of at least c = t / (|q| l) matter:

* a bucket with c > 1 is left out, before anything is shuffled to it;
* for the anchor's ``FOCUS`` largest coordinates f, the angle of p to the axis f
  differs from that of q by at most arccos c.  This is a range of values of
  p_f / |p|, a run in the bucket's sorted list of coordinate f;
* the vectors that are in all these runs are the candidates; their products
  are formed exactly.  Where the runs leave more than ``DENSE`` of a bucket,
  the products of all its vectors with all such anchors are one matrix product.

There are three searches.  The first bucket of each label gives its anchors a
first k best of their own label; the worst of these is the threshold t for the
label's other buckets; then 80 % of the worst positive's score is that for the
negatives, in the buckets that hold other labels.

Anchors travel in groups of bounded size, sorted by the length they need, and
each bucket meets only the groups that need it.

Components are floor(scale * x); products are exact: in doubles while they stay
far below 2^53, else in unbounded integers.

Defined results: rows with a null id or label or vector, or null or non-finite
components take no part; only vectors of an anchor's number of components are
its candidates; rows that share an anchor's id are none of its positives; of
anchor rows that repeat an id the least (label, vector) is the anchor;
candidates that repeat an id are listed each; scores beyond a long are cut to
its range, and compared so; an anchor without positives, or a positive without
negatives in its range (a negative score has none), gives no row; ties go to
the smaller id; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.functions.ordered import PART, range_split, running_sums
from riskframe.llm import vectors as V
from riskframe.session import Scratch
from riskframe.sources.tables import read_table

SCALE = 256.0
EVERY = 100  # ids divisible by this are anchors
POSITIVES, NEGATIVES = 5, 5
LOWEST, HIGHEST = 80, 100  # percent of a positive's score that its negatives may have
FOCUS = 5
DENSE = 0.5
BUCKET, GROUP = 8192, 1024  # vectors and anchors a task gets, about
AT_ONCE = 256  # anchors multiplied at once
SLACK = 1e-9
FOUND = "anchor_id long, wanted long, id long, score long"


class Bucket:
    """Vectors of one number of components: exact values, directions, and sorted coordinate lists made on demand."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")  # so that a stable sort by score puts smaller ids first
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        length = np.sqrt((self.x ** 2).sum(1))
        self.longest = length.max(initial=0)
        self.direction = self.x / np.where(length > 0, length, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.direction[:, f], kind="stable")
            self.lists[f] = order, self.direction[order, f]
        return self.lists[f]

    def candidates(self, q: np.ndarray, least: float) -> np.ndarray | None:
        """Rows whose product with ``q`` can be ``least`` or more; None: too many to list."""
        length = np.sqrt((q ** 2).sum())
        if not least > 0:
            return None
        cosine = least / max(length * self.longest, 1e-300) * (1 - SLACK)
        if cosine > 1:
            return np.zeros(0, np.int64)
        unit = q / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        turn, angle = np.arccos(cosine), np.arccos(np.clip(unit[focus], -1, 1))
        low, high = np.cos(np.minimum(np.pi, angle + turn)) - SLACK, np.cos(np.maximum(0, angle - turn)) + SLACK
        runs = [np.searchsorted(self.sorted_list(f)[1], (a, b + 2 * SLACK)) for f, a, b in zip(focus, low, high)]
        sizes = [b - a for a, b in runs]
        shortest = int(np.argmin(sizes))
        if sizes[shortest] > DENSE * len(self.ids):
            return None
        rows = self.sorted_list(focus[shortest])[0][slice(*runs[shortest])]
        for f, a, b in zip(focus, low, high):
            value = self.direction[rows, f]
            rows = rows[(value >= a) & (value <= b)]
        return np.sort(rows)


def products(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Scores of the rows of ``x`` for the rows of ``q``, one row each; cut to the range of a long."""
    if exact:
        return q @ x.T
    s = V.unbounded(q) @ V.unbounded(x).T
    return np.frompyfunc(V.as_long, 1, 1)(s) if s.size else s


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (id, score) of rows in ascending order of ids."""
    top = np.argsort(-scores, kind="stable")[:k]
    return [(int(ids[i]), int(scores[i])) for i in top]


def _positives(k: int, anchor: dict, ids: np.ndarray, labels: np.ndarray, s: np.ndarray) -> list[tuple]:
    able = np.flatnonzero((labels == anchor["label"]) & (ids != anchor["id"]) & (s >= anchor["least"]))
    return [(None, *found) for found in _best(ids[able], s[able], k)]


def _negatives(k: int, anchor: dict, ids: np.ndarray, labels: np.ndarray, s: np.ndarray) -> list[tuple]:
    able = np.flatnonzero((labels != anchor["label"]) & (s >= anchor["least"]))
    out = []
    for wanted in anchor["wanted"]:  # at most POSITIVES scores
        mine = able[(100 * s[able] >= LOWEST * wanted) & (100 * s[able] <= HIGHEST * wanted)]
        out += [(wanted, *found) for found in _best(ids[mine], s[mine], k)]
    return out


def search(bucket: Bucket, anchors: list[dict], choose) -> tuple[list[tuple], int]:
    """(anchor id, *what ``choose`` finds among the candidates) for every anchor; products formed."""
    out, taken, dense = [], 0, []
    width = bucket.x.shape[1]
    size = np.abs(bucket.x).max(initial=0) * max((np.abs(a["v"]).max(initial=0) for a in anchors), default=0) * max(width, 1)
    exact = 100 * size < V.EXACT
    for a in anchors:
        rows = bucket.candidates(a["v"], a["least"])
        if rows is None:
            dense.append(a)
        elif len(rows):
            s = products(bucket.x[rows], a["v"][None, :], exact)[0]
            taken += len(rows)
            out += [(a["id"], *found) for found in choose(a, bucket.ids[rows], bucket.labels[rows], s)]
    for i in range(0, len(dense), AT_ONCE):
        some = dense[i:i + AT_ONCE]
        scores = products(bucket.x, np.stack([a["v"] for a in some]), exact)
        taken += scores.size
        for a, s in zip(some, scores):
            out += [(a["id"], *found) for found in choose(a, bucket.ids, bucket.labels, s)]
    return out, taken


def _buckets(table: pa.Table) -> dict[int, Bucket]:
    values, widths = V.flat(table.column("v"))
    start = np.cumsum(widths) - widths
    ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
    out = {}
    for n in np.unique(widths):
        rows = np.flatnonzero(widths == n)
        out[int(n)] = Bucket(ids[rows], labels[rows], values[start[rows][:, None] + np.arange(n)].astype(np.float64))
    return out


def _search(choose, left: pa.Table, right: pa.Table) -> pa.Table:
    """left: the vectors of a bucket; right: the anchors of a group."""
    found: list[tuple] = []
    if left.num_rows and right.num_rows:
        anchors: dict[int, list[dict]] = {}
        for row in right.select(["anchor_id", "anchor_label", "anchor_v", "least", "wanted"]).to_pylist():
            v = np.array(row["anchor_v"], np.float64)
            least = -np.inf if row["least"] is None else row["least"]
            anchors.setdefault(len(v), []).append(
                {"id": row["anchor_id"], "label": row["anchor_label"], "v": v, "least": least, "wanted": row["wanted"]})
        for n, bucket in _buckets(left).items():
            if n in anchors:
                found += search(bucket, anchors[n], choose)[0]
    columns = list(zip(*found)) or [[]] * 4
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor_id", "wanted", "id", "score"), columns)})


def _length(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def _grouped(anchors: DataFrame) -> DataFrame:
    """Anchors (.., least) with the length that a vector needs, in groups of GROUP by label and that length."""
    needs = anchors.withColumn("need", F.when(F.col("least") > 0, F.col("least") / F.col("anchor_length")).otherwise(0.0) * (1 - SLACK))
    ranked = running_sums(needs, ["anchor_label", "need", "anchor_id"], {}, row_number="rank")
    return ranked.withColumn("g", F.floor((F.col("rank") - 1) / GROUP)).drop("rank")


def _meet(vectors: DataFrame, anchors: DataFrame, pairs: DataFrame, choose) -> DataFrame:
    """What ``choose`` finds where the buckets and groups of ``pairs`` meet: (bucket, g), or (bucket, label, g)
    for the vectors and anchors of one label alone."""
    keys = [c for c in ("bucket", "label", "g") if c in pairs.columns]
    shared = [k for k in keys if k != "g"]
    left = vectors.join(pairs, shared).select("id", "label", "v", *[F.col(k).alias(f"left_{k}") for k in keys])
    right = anchors.withColumn("label", F.col("anchor_label")).join(pairs, [k for k in keys if k != "bucket"]).select(
        "anchor_id", "anchor_label", "anchor_v", "least", "wanted", *[F.col(k).alias(f"right_{k}") for k in keys])
    grouped = left.groupBy(*[f"left_{k}" for k in keys]).cogroup(right.groupBy(*[f"right_{k}" for k in keys]))
    return grouped.applyInArrow(partial(_search, choose), FOUND)


def _by_label(anchors: DataFrame) -> DataFrame:
    """The groups of each label, and the length that one of their anchors needs at least."""
    return anchors.groupBy(F.col("anchor_label").alias("label"), "g").agg(F.min("need").alias("need"))


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   bucket: int = BUCKET) -> DataFrame:
    """For each anchor its ``positives`` best rows of the same label, and for each of these the ``negatives`` best
    rows of other labels that score 80 to 100 % of it.  ``vectors``: id, label long, v (array of whole-numbered doubles);
    ``is_anchor``: a condition on them.  Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    scratch = Scratch(vectors.sparkSession, "lemp")
    stored = vectors.select("id", "label", "v", _length("v").alias("length"), F.monotonically_increasing_id().alias("row"))
    stored = scratch.write(stored)
    n = max(1, -(-stored.count() // bucket))
    # equal lengths, and copies of a row, go by row number: no bucket outgrows its size by them
    placed = range_split(stored, ["label", F.col("length").desc(), "row"], n).withColumnRenamed(PART, "bucket")
    facts = placed.groupBy("bucket", "label").agg(F.max("length").alias("longest")).checkpoint(eager=True)

    one = placed.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v", "length")).alias("a"))
    anchors = one.select(F.col("id").alias("anchor_id"), F.col("a.label").alias("anchor_label"), F.col("a.v").alias("anchor_v"),
                         F.col("a.length").alias("anchor_length"), F.lit(None).cast("double").alias("least"),
                         F.lit(None).cast("array<long>").alias("wanted")).checkpoint(eager=True)

    # 1. the bucket of each label with its longest vectors
    best = partial(_positives, positives)
    seeds = _grouped(anchors).checkpoint(eager=True)
    first = facts.groupBy("label").agg(F.max_by("bucket", F.struct("longest", "bucket")).alias("bucket"))
    first = first.join(_by_label(seeds), "label").select("bucket", "label", "g").checkpoint(eager=True)
    seeded = _meet(placed, seeds, first, best).checkpoint(eager=True)

    # 2. its other buckets, for what reaches the worst of these
    worst = _ranked(seeded, ["anchor_id"], positives).where(F.col("rank") == positives)
    worst = worst.select(F.col("anchor_id"), F.col("score").cast("double").alias("least"))
    aimed = _grouped(anchors.drop("least").join(worst, "anchor_id", "left")).checkpoint(eager=True)
    rest = facts.join(first.select("bucket", "label").distinct(), ["bucket", "label"], "left_anti")
    pairs = rest.join(_by_label(aimed), "label").where(F.col("longest") >= F.col("need")).select("bucket", "label", "g")
    found = seeded.union(_meet(placed, aimed, pairs.checkpoint(eager=True), best))
    top = _ranked(found, ["anchor_id"], positives).select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).checkpoint(eager=True)

    # 3. the buckets that hold other labels
    goals = top.where("positive_score >= 0").groupBy("anchor_id").agg(F.collect_set("positive_score").alias("wanted"))
    least = F.array_min("wanted").cast("double") * (LOWEST / 100) * (1 - SLACK)
    aimed = _grouped(anchors.drop("least", "wanted").join(goals, "anchor_id").withColumn("least", least)).checkpoint(eager=True)
    spans = aimed.groupBy("g").agg(F.min("need").alias("need"), F.min("anchor_label").alias("low"), F.max("anchor_label").alias("high"))
    held = facts.groupBy("bucket").agg(F.max("longest").alias("longest"), F.min("label").alias("low_2"), F.max("label").alias("high_2"))
    # a row for each bucket and group, not for their rows
    met = spans.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(held, "bucket")
    same = (F.col("low") == F.col("high")) & (F.col("low_2") == F.col("high_2")) & (F.col("low") == F.col("low_2"))
    pairs = met.where((F.col("longest") >= F.col("need")) & ~same).select("bucket", "g").checkpoint(eager=True)
    found = _meet(placed, aimed, pairs, partial(_negatives, negatives))
    chosen = _ranked(found, ["anchor_id", "wanted"], negatives)
    return top.join(chosen.withColumnsRenamed({"id": "negative_id", "score": "negative_score", "anchor_id": "of"}),
                    (F.col("anchor_id") == F.col("of")) & (F.col("positive_score") == F.col("wanted"))).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def labelled(embeddings: DataFrame) -> DataFrame:
    """(id, label, v) of the rows of (vec_id, embedding, label) that take part; labels of ids divisible by 7 go one up."""
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & V.finite("embedding"))
    label = F.col("label").cast("long")
    return rows.select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                       V.floored("embedding", SCALE).alias("v"))


def op13_lemp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(labelled(read_table(spark, sf_dir, "embeddings")), F.col("id") % EVERY == 0)


ORACLE = r"""
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT q.vec_id AS anchor_id, d.vec_id, q.label = d.label AS alike,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * d.e[i])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id AND len(q.e) = len(d.e)),
positives AS (
  SELECT anchor_id, vec_id, score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n
  ON n.anchor_id = p.anchor_id AND NOT n.alike AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
