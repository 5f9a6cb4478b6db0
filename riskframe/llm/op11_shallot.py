"""Centroid clustering (Lloyd's rounds) by Shallot search, exact in whole numbers.

Each vector remembers its centroid and the second-nearest one, an upper bound
of its distance to the former and a lower bound of that to all others.  After
the centroids move, the bounds are moved by as much.  A vector whose upper
bound is below its lower bound, or below half the way to its centroid's
nearest neighbour, keeps its centroid without a look.  For the others:

1. the distances to both remembered centroids are taken; the search starts
   from the closer one;
2. centroids are scanned in ascending distance from the start.  One that is
   nearer than the second-nearest found so far lies within (distance to the
   start + distance to the second-nearest) of the start, so the scan ends
   beyond that ball, which shrinks whenever a closer one is found;
3. what survives is compared by squared distances in integers, ties by number.

Bounds are doubles, rounded outwards; every decision between centroids is one
between exact integers.  A round reads the vectors with their bounds, writes
them again (compressed; the round before is deleted) and adds up the clusters
inside the tasks: a task hands on one sum per cluster and component, whatever
it reads, so a hot cluster is no hot key.  The driver holds the centroids.

Defined results: rows without a vector, of another number of components, or
with null or non-finite components take no part; rows that repeat a ``vec_id``
are vectors of their own; rows without one take part and come last among the
initial centroids; equal hashes go by vec_id, then vector; with fewer vectors
than centroids each is one; copies of a vector may be centroids of their own,
all but the first then stay empty; distances and inertias beyond a long are
cut to its range; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import vectors as V
from riskframe.llm import words as W
from riskframe.session import Scratch
from riskframe.sources.tables import read_table

WIDTH, SCALE, CENTROIDS, ROUNDS, SALT = 64, 256.0, 40, 5, "2:"
SMALL = 1 << 26  # squared distances of 64 components below this fit 64-bit integers
ROWS = 4096  # vectors looked at together
LIMB = 32  # sums travel in pieces of so many bits, so that Spark's long sums of them can't overflow
EPS = 1e-12
STATE = "id long, v array<double>, cluster int, second int, upper double, lower double"


class Centroids(NamedTuple):
    exact: np.ndarray  # (k, width) int64, or Python integers if some component is large
    near: np.ndarray  # (k, k): centroids by distance from each one
    gap: np.ndarray  # (k, k): those distances, ascending
    half: np.ndarray  # (k,): half the distance to the nearest other one
    drift: np.ndarray  # (k,): how far each one has moved since the bounds were made
    others: np.ndarray  # (k,): the largest drift among the others


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``x`` to the same row of ``c``, exact."""
    d = x - c
    return (d * d).sum(1) if d.dtype == object else np.einsum("ij,ij->i", d, d)


def whole(x: np.ndarray) -> np.ndarray:
    """Whole-numbered doubles as 64-bit integers, or unbounded ones if squares could overflow."""
    return x.astype(np.int64) if np.abs(x).max(initial=0) < SMALL else V.unbounded(x)


def prepare(exact: list[list[int]], before: list[list[int]] | None) -> Centroids:
    """Neighbours of the centroids, and how far they are from those ``before`` (None: bounds start anew)."""
    large = any(abs(v) >= SMALL for row in exact + (before or []) for v in row)
    c = np.array(exact, object if large else np.int64).reshape(len(exact), -1)
    k = len(c)
    gaps = np.stack([_root(squared(c, np.repeat(c[i:i + 1], k, 0))) for i in range(k)])
    np.fill_diagonal(gaps, -1.0)  # itself comes first
    near = np.argsort(gaps, 1, kind="stable")
    gap = np.maximum(np.take_along_axis(gaps, near, 1), 0) * (1 - EPS)
    half = gap[:, 1] / 2 if k > 1 else np.full(1, np.inf)
    drift = _root(squared(c, np.array(before, c.dtype))) * (1 + EPS) if before else np.full(k, np.inf)
    top = np.sort(drift)[::-1]
    others = np.where(np.arange(k) == drift.argmax(), top[1] if k > 1 else 0.0, top[0])
    return Centroids(c, near, gap, half, drift, others)


def assign(x: np.ndarray, cent: Centroids, cluster: np.ndarray, second: np.ndarray, upper: np.ndarray,
           lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """New (cluster, second, upper, lower) of the rows of ``x``, and the number of distances taken."""
    cluster, second = cluster.copy(), second.copy()
    upper = (upper + cent.drift[cluster]) * (1 + EPS)
    lower = lower - cent.others[cluster]
    lower -= np.abs(lower) * EPS
    lower[np.isnan(lower)] = -np.inf
    c, k = cent.exact, len(cent.exact)
    if x.dtype != c.dtype:
        x, c = (V.unbounded(m) if m.dtype != object else m for m in (x, c))

    def sure(rows: np.ndarray) -> np.ndarray:
        return upper[rows] < np.maximum(lower[rows], cent.half[cluster[rows]])

    rows = np.arange(len(x))
    rows = rows[~sure(rows)]
    first = squared(x[rows], c[cluster[rows]])
    taken = len(rows)
    upper[rows] = _root(first) * (1 + EPS)
    open_ = ~sure(rows)
    rows, first = rows[open_], first[open_]
    if k > 1 and len(rows):
        a, b = cluster[rows], second[rows]
        d1, d2 = first, squared(x[rows], c[b])
        taken += len(rows)
        swap = (d2 < d1) | ((d2 == d1) & (b < a))
        best, other = np.where(swap, b, a), np.where(swap, a, b)
        d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
        start, known = best.copy(), other.copy()
        away, ball = _root(d1), _root(d2)
        active = np.arange(len(rows))
        for r in range(1, k):
            j = cent.near[start[active], r]
            inside = cent.gap[start[active], r] <= (away[active] + ball[active]) * (1 + EPS)
            active, j = active[inside], j[inside]
            if not len(active):
                break
            new = j != known[active]
            at, j = active[new], j[new]
            d = squared(x[rows[at]], c[j])
            taken += len(at)
            closest = (d < d1[at]) | ((d == d1[at]) & (j < best[at]))
            closer = ~closest & ((d < d2[at]) | ((d == d2[at]) & (j < other[at])))
            one, two = at[closest], at[closer]
            other[one], d2[one], best[one], d1[one] = best[one], d1[one], j[closest], d[closest]
            other[two], d2[two] = j[closer], d[closer]
            ball[one], ball[two] = _root(d2[one]), _root(d2[two])
        cluster[rows], second[rows] = best, other
        upper[rows], lower[rows] = _root(d1) * (1 + EPS), ball * (1 - EPS)
    return cluster, second, upper, lower, taken


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            yield part, whole(V.matrix(part.column(batch.schema.get_field_index("v")), WIDTH))


def _assign(cent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, x in _rows(batches):
        state = [part.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
        new = assign(x, cent.value, *state)[:4]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *map(pa.array, new)], schema=part.schema)
    W.release()


def _limbs(x: int) -> list[int]:
    """x in pieces of LIMB bits, the last one signed."""
    out = []
    while not -(1 << LIMB) <= x < 1 << LIMB:
        out.append(x & ((1 << LIMB) - 1))
        x >>= LIMB
    return [*out, x]


def _sums(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros((k, WIDTH), object), np.zeros(k, np.int64)
    for part, x in _rows(batches):
        cluster = part.column(part.schema.get_field_index("cluster")).to_numpy(zero_copy_only=False)
        order = np.argsort(cluster, kind="stable")
        here, at, count = np.unique(cluster[order], return_index=True, return_counts=True)
        total[here] += np.add.reduceat(x[order], at, axis=0)
        n[here] += count
    found = [(i, p, limb, v) for i in np.flatnonzero(n) for p, s in enumerate([*total[i], int(n[i])]) for limb, v in enumerate(_limbs(int(s)))]
    names, kinds = ("cluster", "place", "limb", "value"), (pa.int32(), pa.int32(), pa.int32(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)] if found else [pa.array([], t) for t in kinds],
                                     names=list(names))


def _moved(state: DataFrame, before: list[list[int]]) -> list[list[int]]:
    """The floored means of the clusters; an empty one stays."""
    sums = (state.select("v", "cluster").mapInArrow(partial(_sums, len(before)), "cluster int, place int, limb int, value long")
            .groupBy("cluster", "place", "limb").agg(F.sum("value").alias("value")))
    total = [[0] * (WIDTH + 1) for _ in before]
    for r in sums.collect():  # centroids x components x a few limbs
        total[r["cluster"]][r["place"]] += r["value"] << (LIMB * r["limb"])
    return [[s // t[-1] for s in t[:-1]] if t[-1] else old for t, old in zip(total, before)]


def _measure(cent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, x in _rows(batches):
        cluster = part.column(2).to_numpy(zero_copy_only=False)
        c = cent.value.exact
        if x.dtype != c.dtype:
            x, c = (V.unbounded(m) if m.dtype != object else m for m in (x, c))
        d = squared(x, c[cluster])
        d = pa.array([V.as_long(i) for i in d] if d.dtype == object else d, pa.int64())
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), d], names=["id", "cluster", "distance"])


def initial(vectors: DataFrame, k: int, salt: str = SALT) -> list[list[int]]:
    """The ``k`` vectors with the least sha256 of salt and id."""
    order = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256)
    first = vectors.orderBy(order.asc_nulls_last(), F.col("id").asc_nulls_last(), "v").limit(k).select("v")
    return [[int(x) for x in r["v"]] for r in first.collect()]  # k rows


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = SALT) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, squared distance of every vector; the centroids after ``rounds`` rounds).

    ``vectors``: id, v (array of ``WIDTH`` whole-numbered doubles)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "shallot")
    centroids = initial(vectors, k, salt)
    if not centroids:
        return vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    second = F.lit(min(1, len(centroids) - 1))
    state = vectors.select("id", "v", F.lit(0).alias("cluster"), second.alias("second"),
                           F.lit(float("inf")).alias("upper"), F.lit(float("-inf")).alias("lower"))
    before = None
    for i in range(rounds + 1):
        shared = spark.sparkContext.broadcast(prepare(centroids, before))
        state = scratch.write(state.mapInArrow(partial(_assign, shared), STATE))
        scratch.drop_before(1)
        if i < rounds:
            before, centroids = centroids, _moved(state, centroids)
    return state.select("id", "v", "cluster").mapInArrow(partial(_measure, shared), "id long, cluster int, distance long"), centroids


def _sha256(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def op11_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").where(V.finite("embedding") & (F.size("embedding") == WIDTH))
    found, centroids = cluster(rows.select(F.col("vec_id").alias("id"), V.floored("embedding", SCALE).alias("v")))
    cut = lambda total: F.least(total, F.lit(V.HIGH).cast("decimal(38,0)")).cast("long")
    by_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()  # a row a centroid
    inertia = F.lit(sum((r["sum"] for r in by_cluster), 0)).cast("decimal(38,0)")
    facts = spark.createDataFrame([(r["cluster"], r["sum"], _sha256(centroids[r["cluster"]])) for r in by_cluster],
                                  "of int, sum decimal(38,0), centroid_sha256 string")
    return found.join(F.broadcast(facts), F.col("cluster") == F.col("of")).select(
        F.col("id").alias("vec_id"), "cluster", "distance", cut(F.col("sum")).alias("cluster_inertia"), cut(inertia).alias("inertia"),
        "centroid_sha256")


def _oracle() -> str:
    """One block of SQL per round."""
    rounds = [f"""
a{r} AS MATERIALIZED (
  SELECT rid, arg_min(n, (d, n)) AS n, min(d) AS d FROM (
    SELECT rid, n, list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) AS d FROM v, c{r} c)
  GROUP BY rid)""" for r in range(ROUNDS + 1)]
    moves = [f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.n, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
    SELECT n, list(CAST(floor_ AS BIGINT) ORDER BY i) AS e FROM (
      SELECT n, i, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS floor_ FROM (
        SELECT a.n, unnest(v.e) AS x, unnest(range(1, 65)) AS i FROM v JOIN a{r} a USING (rid))
      GROUP BY n, i) GROUP BY n) m USING (n))""" for r in range(ROUNDS)]
    blocks = [b for pair in zip(rounds, [*moves, ""]) for b in pair if b]
    return r"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id, embedding) - 1 AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT rid AS n, e FROM v WHERE rid < 40),""" + ",".join(blocks) + f""",
clusters AS (SELECT n, sum(d) AS s FROM a{ROUNDS} GROUP BY n)
SELECT v.vec_id, CAST(a.n AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(k.s AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(d) FROM a{ROUNDS}) AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM v JOIN a{ROUNDS} a USING (rid) JOIN clusters k USING (n) JOIN c{ROUNDS} c USING (n)
"""


ORACLE = _oracle()
