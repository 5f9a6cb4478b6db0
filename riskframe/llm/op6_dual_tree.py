"""Exact top-k by inner product with dual-tree search over cover trees.

Vectors and queries fall into cells, each that of the nearest of at most
``PIVOTS`` pivots (vectors with the least hashed ids); cells are the top level
of the trees.  A cell is dealt into blocks of vectors, or groups of queries, of
bounded size, by a hash of row numbers, so copies of one vector spread out.
Every group first meets one block of its own cell.  That gives its queries a
worst k-th score, and of the other blocks only those are shuffled to the group
whose pivots and radii allow a higher one (the bound below).  Each task gets
one block and one group.  It builds a cover tree of either (a node's centre is
one of its points; its children's centres are chosen farthest first, so they
lie far apart; a node keeps the exact radius that covers its points) and
searches both trees together.  A pair of nodes can hold no inner product above

    <q, d> + r_q |d| + r_d |q| + r_q r_d        (centres q, d; radii r_q, r_d)

and is pruned if that is below the worst k-th score of the query node's
queries.  Leaf pairs are scored by one matrix product.  The tasks' k best per
query are merged by a ranking with a limit per group.

Components are floor(scale * x); products and sums of them are exact: in
doubles while they stay below 2^53, else in unbounded integers.

Defined results: vectors that are null, or hold null or non-finite components,
and rows without an id take no part; only vectors of a query's length are its
candidates; rows that share a query's id are none; of query rows that repeat
an id the least vector is the query; candidates that repeat an id are listed
each; ties go to the smaller id; scores beyond a long are cut to its range;
with fewer than k candidates all are returned; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.tables import read_table

K = 10
SCALE = 1024.0
EVERY = 100  # ids divisible by this are queries
BLOCK, GROUP = 8192, 2048  # vectors and queries a task gets, about
PIVOTS = 256
LEAF, FANOUT = 128, 12
EXACT = float(1 << 53)
LOW, HIGH = -(1 << 63), (1 << 63) - 1


class Node:
    __slots__ = ("points", "centre", "norm", "radius", "children")

    def __init__(self, points: np.ndarray, centre: np.ndarray, radius: float):
        self.points, self.centre, self.radius = points, centre, radius
        self.norm, self.children = float(np.sqrt(centre @ centre)), []


def cover_tree(x: np.ndarray, points: np.ndarray | None = None, first: int | None = None) -> Node:
    """A tree over the rows ``points`` of ``x``; ``first`` is the row at the root's centre."""
    points = np.arange(len(x)) if points is None else points
    if first is None:
        first = points[np.argmin(((x[points] - x[points].mean(0)) ** 2).sum(1))]
    away = np.sqrt(((x[points] - x[first]) ** 2).sum(1))
    node = Node(points, x[first], float(away.max()))
    if len(points) <= LEAF or node.radius == 0:
        return node
    centres, owner = [first], np.zeros(len(points), int)
    while len(centres) < FANOUT and away.max() > node.radius / 2:
        centres.append(points[int(away.argmax())])
        to_new = np.sqrt(((x[points] - x[centres[-1]]) ** 2).sum(1))
        owner[to_new < away] = len(centres) - 1
        away = np.minimum(away, to_new)
    node.children = [cover_tree(x, points[owner == i], c) for i, c in enumerate(centres) if (owner == i).any()]
    return node


class Search:
    """The k best of rows ``d`` (with ids) for every row of ``q``, by score, then id."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, d: np.ndarray, d_ids: np.ndarray, k: int, least: np.ndarray | None = None):
        """``least``: scores below these (one per row of ``q``) aren't wanted."""
        self.q, self.q_ids, self.d, self.d_ids, self.k = q, q_ids, d, d_ids, k
        self.least = np.full(len(q), -np.inf) if least is None else least
        self.scores, self.ids = np.full((len(q), k), -np.inf), np.full((len(q), k), HIGH)
        self.products = 0
        # distances and bounds are rounded; this much covers it
        size = np.abs(q).max(initial=0) * np.abs(d).max(initial=0) * q.shape[1]
        self.slack = 1e-9 * size
        if len(q) and len(d):
            self.visit(cover_tree(q), cover_tree(d))

    def bound(self, a: Node, b: Node) -> float:
        return float(a.centre @ b.centre) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius + self.slack

    def visit(self, a: Node, b: Node) -> None:
        if self.bound(a, b) < np.maximum(self.scores[a.points, -1], self.least[a.points]).min():
            return
        if not a.children and not b.children:
            self.score(a.points, b.points)
        elif a.children and (not b.children or a.radius > b.radius):
            for child in a.children:
                self.visit(child, b)
        else:
            for child in sorted(b.children, key=lambda c: -self.bound(a, c)):
                self.visit(a, child)

    def score(self, rows: np.ndarray, points: np.ndarray) -> None:
        s = self.q[rows] @ self.d[points].T
        self.products += s.size
        s[self.q_ids[rows][:, None] == self.d_ids[points]] = -np.inf
        better = (s >= self.scores[rows, -1:]).any(1)
        rows, s = rows[better], s[better]
        scores = np.concatenate([self.scores[rows], s], 1)
        ids = np.concatenate([self.ids[rows], np.broadcast_to(self.d_ids[points], s.shape)], 1)
        best = np.lexsort((ids, -scores), axis=1)[:, :self.k]
        self.scores[rows], self.ids[rows] = np.take_along_axis(scores, best, 1), np.take_along_axis(ids, best, 1)

    def rows(self) -> list[tuple[int, int, int]]:
        found = np.isfinite(self.scores)
        return [(int(self.q_ids[i]), int(self.ids[i, j]), int(self.scores[i, j])) for i, j in zip(*np.nonzero(found))]


def _unbounded(q: np.ndarray, q_ids: np.ndarray, d: np.ndarray, d_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The same by unbounded integers, for components whose products a double can't hold."""
    as_int = [[int(x) for x in row] for row in d]
    out = []
    for i, row in zip(q_ids, q):
        row = [int(x) for x in row]
        scored = [(-sum(map(int.__mul__, row, other)), int(j)) for other, j in zip(as_int, d_ids) if j != i]
        out += [(int(i), j, min(max(-s, LOW), HIGH)) for s, j in sorted(scored)[:k]]
    return out


def top_k(q: np.ndarray, q_ids: np.ndarray, d: np.ndarray, d_ids: np.ndarray, k: int,
          least: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the k best rows of ``d`` for each row of ``q``."""
    if np.abs(q).max(initial=0) * np.abs(d).max(initial=0) * max(q.shape[1], 1) >= EXACT:
        return _unbounded(q, q_ids, d, d_ids, k)
    return Search(q, q_ids, d, d_ids, k, least).rows()


def _by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, vectors and row numbers of a table (id, v, ...) by length of the vectors."""
    ids = table.column("id").to_numpy()
    column = table.column("v").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    values, lengths = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    start = np.cumsum(lengths) - lengths
    out = {}
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out[int(n)] = ids[rows], values[start[rows][:, None] + np.arange(n)].astype(np.float64), rows
    return out


def _search(k: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """left: the vectors of a block; right: the queries of a group."""
    found = []
    if left.num_rows and right.num_rows:
        candidates = _by_length(left)
        least = right.column("least").to_numpy(zero_copy_only=False).astype(np.float64)
        for n, (q_ids, q, rows) in _by_length(right).items():
            if n in candidates:
                found += top_k(q, q_ids, candidates[n][1], candidates[n][0], k, np.nan_to_num(least[rows], nan=-np.inf))
    columns = list(zip(*found)) or [[], [], []]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})


def _nearest(pivots, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to (id, v, row) the cell, by the nearest pivot of as many components (without one: by their number alone)."""
    for batch in batches:
        cell, away = np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, np.inf)
        for n, (_, x, rows) in _by_length(pa.Table.from_batches([batch])).items():
            mine = [i for i, p in enumerate(pivots.value) if len(p) == n]
            cell[rows] = -n - 1
            if mine:
                c = np.array([pivots.value[i] for i in mine])
                with np.errstate(over="ignore", invalid="ignore"):
                    best = ((x ** 2).sum(1)[:, None] - 2 * x @ c.T + (c ** 2).sum(1)).argmin(1)
                    cell[rows], away[rows] = np.array(mine)[best], np.sqrt(((x - c[best]) ** 2).sum(1))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], names=[*batch.schema.names, "cell", "away"])


def _dealt(rows: DataFrame, size: int, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their part of the cell, a row per part: cell, part, radius), parts of about ``size`` rows."""
    parts = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    rows = rows.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts")
    rows = rows.withColumnsRenamed({"cell": f"{prefix}cell", "part": f"{prefix}part"}).checkpoint(eager=True)
    return rows, rows.groupBy(f"{prefix}cell", f"{prefix}part").agg(F.max("away").alias(f"{prefix}radius")).checkpoint(eager=True)


def useful_pairs(blocks: DataFrame, groups: DataFrame, pivots: list[list[float]]) -> DataFrame:
    """The (block, group) pairs in which a score of the group's ``worst`` or more is possible."""
    spark = blocks.sparkSession
    norm = [float(np.linalg.norm(p)) for p in pivots]
    near = [(i, j, float(np.dot(a, b)), norm[i], norm[j]) for i, a in enumerate(pivots) for j, b in enumerate(pivots) if len(a) == len(b)]
    # at most PIVOTS squared rows
    centres = spark.createDataFrame(near, "gcell long, bcell long, product double, gnorm double, bnorm double")
    r, q = F.col("bradius"), F.col("gradius")
    bound = F.col("product") + q * F.col("bnorm") + r * F.col("gnorm") + q * r
    size = F.abs("product") + (F.col("bnorm") + r) * (F.col("gnorm") + q)
    met = groups.join(centres, "gcell").join(blocks, "bcell").withColumn("bound", bound + size * 1e-9)
    met = met.where(F.col("worst").isNull() | F.isnan("bound") | (F.col("bound") >= F.col("worst")))
    alone = groups.where("gcell < 0").join(blocks, F.col("gcell") == F.col("bcell"))  # vectors of a length without a pivot
    keys = ["bcell", "bpart", "gcell", "gpart"]
    return met.select(*keys).union(alone.select(*keys))


def _meet(vectors: DataFrame, queries: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    keys = ["bcell", "bpart", "gcell", "gpart"]
    left = vectors.join(pairs, ["bcell", "bpart"]).select("id", "v", *[F.col(c).alias(f"l{c}") for c in keys])
    right = queries.join(pairs, ["gcell", "gpart"]).select("id", "v", "least", *[F.col(c).alias(f"r{c}") for c in keys])
    return left.groupBy(*[f"l{c}" for c in keys]).cogroup(right.groupBy(*[f"r{c}" for c in keys])).applyInArrow(
        partial(_search, k), "query_id long, vec_id long, score long")


def search(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, group: int = GROUP, stats: dict | None = None) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product for each row of ``queries`` (both: id,
    v array of whole-numbered doubles): query_id, rank, vec_id, score.  ``stats`` takes the numbers of blocks,
    groups and pairs searched."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    numbered = lambda df: df.select("id", "v", F.monotonically_increasing_id().alias("row")).checkpoint(eager=True)
    vectors, queries = numbered(vectors), numbered(queries.groupBy("id").agg(F.min("v").alias("v")))
    wanted = min(PIVOTS, -(-vectors.count() // block))
    pivots = [r["v"] for r in vectors.orderBy(F.xxhash64("id"), "id", "v").limit(wanted).select("v").collect()]  # at most PIVOTS rows
    placed = partial(_nearest, spark.sparkContext.broadcast(pivots))
    schema = "id long, v array<double>, row long, cell long, away double"
    vectors, blocks = _dealt(vectors.mapInArrow(placed, schema), block, "b")
    queries, groups = _dealt(queries.mapInArrow(placed, schema), group, "g")
    keys, best = ["bcell", "bpart", "gcell", "gpart"], Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    own = groups.join(blocks.where("bpart = 0"), F.col("gcell") == F.col("bcell")).select(*keys).checkpoint(eager=True)
    first = _meet(vectors, queries.withColumn("least", F.lit(None).cast("double")), own, k).checkpoint(eager=True)
    kth = ranked(first).where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.col("score").cast("double").alias("s"))
    kth = kth.select("of", (F.col("s") - F.abs("s") * 1e-9).alias("least"))
    queries = queries.join(kth, queries["id"] == kth["of"], "left").drop("of").checkpoint(eager=True)
    worst = queries.groupBy("gcell", "gpart").agg(F.when(F.count("least") == F.count(F.lit(1)), F.min("least")).alias("worst"))
    pairs = useful_pairs(blocks, groups.join(worst, ["gcell", "gpart"]), pivots).join(own, keys, "left_anti").checkpoint(eager=True)
    if stats is not None:
        stats |= {"blocks": blocks.count(), "groups": groups.count(), "pairs": own.count() + pairs.count()}
    return ranked(first.union(_meet(vectors, queries, pairs, k))).select("query_id", "rank", "vec_id", "score")


def whole_numbered(embeddings: DataFrame, scale: float = SCALE) -> DataFrame:
    """(id, v) of the rows of (vec_id, embedding) that take part, v = floor(scale * x) as doubles."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform("embedding", lambda x: _floor(x.cast("double") * scale))
    return embeddings.where("vec_id is not null and embedding is not null").where(~bad).select(F.col("vec_id").alias("id"), v.alias("v"))


def _floor(x):
    """floor() as a double: Spark's own gives a long, which cuts large values."""
    whole = F.rint(x)
    return F.when(whole > x, whole - 1).otherwise(whole)


def op6_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_numbered(read_table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where(F.col("id") % EVERY == 0))


ORACLE = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * d.e[i])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id AND len(q.e) = len(d.e)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
