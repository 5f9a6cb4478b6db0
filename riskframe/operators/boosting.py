"""Boosted trees with regularised leaves, stopped by the AUC of held-out rows.

A round fits one regression tree to the gradient of the weighted log loss; no
row leaves the executors.  The limits between the bins of each feature are
found once, by the rule and from the sample of ``spark.ml``'s trees; all rows
are then kept as blocks of bin numbers with their margins.  A level of a tree is
at most one job: tasks add up weights and gradients by (node, feature, bin), and
their sums choose the splits with the largest loss of variance.  A job also
guesses the levels below from the trees before; those guessed right need no job.
(With ``bagging`` the limits follow the weights of each round, so a round there is
a ``spark.ml`` fit.)
The leaves are fitted by one Newton step with L2: the sums of gradients and
hessians per leaf give the leaf

    sum(w g) / (sum(w h) + l2)        g = y - p,  h = p (1 - p),  p = 1 / (1 + exp(-margin))

Every ``EVERY`` rounds (or later, where that can't stop the boosting yet) the
held-out rows get their margins after each new tree, as one array column, and
``metrics.staged_auc`` takes the exact AUC after each tree from one grouped
running sum.  Boosting stops once the best AUC is ``patience`` rounds old, and the
trees after the best one are dropped.

A fitted ensemble is a list of small arrays (feature, threshold, children,
value).  Rows are scored by an Arrow UDF that walks all trees with numpy; a
tree's nodes are also a table, which is how a model is stored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.ordered import shuffle_partitions
from riskframe.operators.features import LABEL, align_features
from riskframe.operators.metrics import staged_auc
from riskframe.session import ensure_checkpoint_dir

SEED = 42
EVERY = 10  # rounds between two looks at the held-out rows; looks that can't stop the boosting yet are taken together
LOOK = 1 << 22  # margins of held-out rows (about) that one look takes, if it's not of ``EVERY`` rounds
STORE_EVERY = 5  # rounds after which the margins are checkpointed
BINS = 32  # of a feature, as in ``spark.ml``'s trees
SAMPLE = 10_000  # rows (about) whose values give the limits between bins, as in ``spark.ml``'s trees; all rows are binned
SAMPLE_SEED = 444206279  # what they make of ``SEED``
BLOCK = 1 << 15  # rows in a block
TASK_ROWS = 1 << 16, 1 << 22  # a task has at least, where there are more cores, and at most so many rows
SEEN = 1 << 16  # nodes of earlier trees that serve as guesses
MARGINS_EVERY = 5  # rounds after which the blocks are stored with new margins; the tasks walk the trees since then
KEEP_EVERY = 25  # rounds after which the blocks are checkpointed
PURE = 2.0 ** -52  # a node of less variance isn't split
ROUNDING = 1e-13  # share of the squares that is no variance
RANGE_ROWS = 1 << 17  # margins that one task sorts at least to find the AUC
LOWEST = -1e300  # stands for a missing value: it is less than any other (infinite ones are cut to its size)
NODES = "tree int, node int, feature int, threshold double, left int, right int, value double"
_BRANCH = re.compile(r"\s*(If|Else) \(feature (\d+) (?:<=|>) ([-+.\dEeInfity]+)\)")


class Tree(NamedTuple):
    """Nodes in pre-order; ``feature`` is -1 at a leaf; a row goes left if its feature is at most the threshold."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @property
    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.feature < 0)

    def with_leaves(self, values) -> Tree:
        value = self.value.copy()
        value[self.leaves] = values
        return self._replace(value=value)

    def reached(self, x: np.ndarray) -> np.ndarray:
        """The leaf node of every row of ``x`` (rows, features)."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            at = node[rows]
            rows = rows[self.feature[at] >= 0]
            at = node[rows]
            node[rows] = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return node


def tree_of(nodes: list[tuple[int, float, int, int, float]]) -> Tree:
    columns = list(zip(*nodes))
    return Tree(*[np.array(c, t) for c, t in zip(columns, (np.int64, np.float64, np.int64, np.int64, np.float64))])


def parse_tree(text: str) -> Tree:
    """A tree from the text that ``spark.ml`` tree models print (continuous features only)."""
    lines = [line for line in text.splitlines()[1:] if line.strip()]
    nodes: list[list] = []

    def read(i: int) -> int:
        here = len(nodes)
        nodes.append([-1, 0.0, -1, -1, 0.0])
        if lines[i].strip().startswith("Predict:"):
            nodes[here][4] = float(lines[i].split(":")[1])
            return i + 1
        branch = _BRANCH.match(lines[i])
        if not branch or branch[1] != "If":
            raise ValueError(f"not a split on a continuous feature: {lines[i].strip()!r}")
        nodes[here][:2] = int(branch[2]), float(branch[3])
        nodes[here][2] = len(nodes)
        i = read(i + 1)
        nodes[here][3] = len(nodes)
        return read(i + 1)  # after the line of the else branch

    read(0)
    return tree_of([tuple(n) for n in nodes])


class Boosted:
    """An ensemble: margin = sum of rate * leaf value over the trees; probability = 1 / (1 + exp(-margin))."""

    def __init__(self, features: list[str], trees: list[Tree], rates: list[float]):
        self.features, self.trees, self.rates = list(features), list(trees), [float(r) for r in rates]

    @staticmethod
    def of_pipeline(model: PipelineModel) -> Boosted:
        """The trees of a fitted ``VectorAssembler`` + ``GBTClassifier``, whose margin is half of the log odds."""
        gbt = model.stages[-1]
        trees = [parse_tree(t.toDebugString) for t in gbt.trees]
        return Boosted(model.stages[0].getInputCols(), trees, [2.0 * w for w in gbt.treeWeights])

    def _staged(self, df: DataFrame, total: bool) -> Column:
        """Margins after each tree, or after the last one alone."""
        trees, rates = self.trees, self.rates
        shared = df.sparkSession.sparkContext.broadcast((trees, rates))

        def margins(*columns: pd.Series) -> pd.Series:
            trees, rates = shared.value
            x = np.column_stack([pd.to_numeric(c).to_numpy(np.float64, na_value=np.nan) for c in columns])
            x = np.clip(np.nan_to_num(x, nan=LOWEST, posinf=-LOWEST, neginf=LOWEST), LOWEST, -LOWEST)
            out = np.zeros(len(x)) if total else np.empty((len(x), len(trees)))
            margin = np.zeros(len(x))
            for i, (tree, rate) in enumerate(zip(trees, rates)):
                margin = margin + rate * tree.value[tree.reached(x)]
                if not total:
                    out[:, i] = margin
            return pd.Series(margin if total else list(out))

        udf = F.pandas_udf(margins, "double" if total else "array<double>")
        return udf(*[F.col(f"`{c}`").cast("double") for c in self.features])

    def margin(self, df: DataFrame) -> Column:
        return self._staged(df, True) if self.trees else F.lit(0.0)

    def staged_margins(self, df: DataFrame) -> Column:
        return self._staged(df, False)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds probability, prediction and rawPrediction; raises if a feature is missing, ignores further columns."""
        align_features(df, self.features)
        m = df.withColumn("_margin", self.margin(df))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        return m.withColumns({"probability": F.array(F.lit(1.0) - p, p), "prediction": (F.col("_margin") > 0).cast("double"),
                              "rawPrediction": F.array(-F.col("_margin"), F.col("_margin"))})

    def nodes(self, spark: SparkSession) -> DataFrame:
        rows = [(t, n, *[x.item() for x in node]) for t, tree in enumerate(self.trees) for n, node in enumerate(zip(*tree))]
        return spark.createDataFrame(rows, NODES)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = json.dumps({"features": self.features, "rates": self.rates})
        # the meta file is written last: a folder without it is no model
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(path: str) -> Boosted:
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        trees: list[list[tuple]] = [[] for _ in meta["rates"]]
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # the trees' nodes
            trees[r["tree"]].append(tuple(r)[2:])
        return Boosted(meta["features"], [tree_of(t) for t in trees], meta["rates"])


def leaf_values(df: DataFrame, leaf: str, margin: str, label: str, weight: str, l2: float) -> DataFrame:
    """(leaf, value): the Newton step of each leaf with L2 regularisation."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(margin)))
    g, h = F.col(label).cast("double") - p, p * (F.lit(1.0) - p)
    sums = df.groupBy(leaf).agg(F.sum(F.col(weight) * g).alias("g"), F.sum(F.col(weight) * h).alias("h"))
    bottom = F.col("h") + F.lit(float(l2))
    return sums.select(leaf, F.when(bottom > 0, F.col("g") / bottom).otherwise(0.0).alias("value"))


def best_round(history: list[float | None], patience: int | None, start: float | None = None) -> tuple[int, bool]:
    """(rounds with the best AUC, whether to stop): the first best one counts; ``start`` is the AUC of no round."""
    best, top = 0, start
    for i, auc in enumerate(history, 1):
        if auc is not None and (top is None or auc > top):
            best, top = i, auc
        if patience is not None and i - best >= patience:
            return best, True
    return best, False


def _present(x: Column) -> Column:
    """A feature as the trees see it: finite, missing as the least value."""
    return F.when(x.isNull() | F.isnan(x), F.lit(LOWEST)).otherwise(F.greatest(F.least(x, F.lit(-LOWEST)), F.lit(LOWEST)))


# ---------------------------------------------------------------- trees from histograms
class Block(NamedTuple):
    """Rows of one task: bin numbers (features, rows), labels, weights (both in the narrowest type) and margins."""
    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    margin: np.ndarray


class Binned(NamedTuple):
    """A tree on bin numbers, level by level: a row goes from a node to ``child``, or to the next node if its bin of
    ``feature`` is above ``cut``; a leaf is its own child."""
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray

    def reached(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The nodes of all rows after so many levels."""
        n = bins.shape[1]
        node, rows, flat, start = np.zeros(n, np.int64), np.arange(n), bins.ravel(), self.feature * n
        for _ in range(levels):
            node = self.child[node] + (flat[start[node] + rows] > self.cut[node])
        return node

    def arrived(self, bins: np.ndarray, levels: int, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that come to a node with a slot after so many levels, ascending, and these slots.  Rows from which
        no such node can be reached any more are left on the way."""
        leads, met, inner = slots >= 0, np.arange(len(slots)) == 0, self.child != np.arange(len(slots))
        for _ in range(levels):
            leads[inner] |= leads[self.child[inner]] | leads[self.child[inner] + 1]
            below = self.child[met & inner]
            met[below] = met[below + 1] = True
        every, n = leads[met].all(), bins.shape[1]
        node, rows, flat, start = np.zeros(n, np.int64), np.arange(n), bins.ravel(), self.feature * n
        for _ in range(levels):
            node = self.child[node] + (flat[start[node] + rows] > self.cut[node])
            if not every:
                on = leads[node]
                if 4 * np.count_nonzero(on) < 3 * len(on):
                    node, rows = node[on], rows[on]
        at = slots[node]
        live = at >= 0
        return (rows, at) if live.all() else (rows[live], at[live])


def limits_of(values: np.ndarray, weights: np.ndarray, rows: int, expected: float, bins: int = BINS) -> list[float]:
    """Limits between the bins of one feature by the rule of ``spark.ml``: halfway between neighbouring values, all of them
    if they're few, else those nearest to equal weights.  ``values`` are distinct and not 0; the rest of the ``expected``
    weight is that of 0."""
    zero = expected - weights.sum()
    if len(values) and zero > PURE * rows * 100:
        values, weights = np.append(values, 0.0), np.append(weights, zero)
    order = np.argsort(values)
    values, reached = values[order], np.cumsum(weights[order])
    halfway = [float(a + b) / 2.0 for a, b in zip(values, values[1:])]
    if len(halfway) < bins:
        return halfway
    stride, found = expected / bins, []
    for i, limit in enumerate(halfway):
        target = stride * (len(found) + 1)
        if abs(reached[i] - target) < abs(reached[i + 1] - target):
            found.append(limit)
    return found


def bin_limits(d: DataFrame, n: int, weight: float, features: int) -> list[np.ndarray]:
    """Limits between the bins of each feature; ``n`` and ``weight`` are the sums of the rows and of their weights."""
    spark, share = d.sparkSession, min(1.0, SAMPLE / n)
    if share < 1:
        rows = d._jdf.toJavaRDD().sample(False, share, SAMPLE_SEED)  # the very rows that spark.ml's trees take
        d = DataFrame(spark._jsparkSession.createDataFrame(rows, d._jdf.schema()), spark)
    cells = d.select("_w", F.posexplode(vector_to_array("_features")).alias("feature", "value")).where("value <> 0")
    counts = cells.groupBy("feature", "value").agg(F.sum("_w").alias("w"), F.count(F.lit(1)).alias("n"))

    def limits(g: pd.DataFrame) -> pd.DataFrame:
        found = limits_of(g["value"].to_numpy(), g["w"].to_numpy(), int(g["n"].sum()), share * weight)
        return pd.DataFrame({"feature": [g["feature"].iloc[0]], "limits": [found]})

    found = {r["feature"]: r["limits"] for r in counts.groupBy("feature").applyInPandas(limits, "feature int, limits array<double>").collect()}
    return [np.array(found.get(f, []), np.float64) for f in range(features)]


def pack(batches: Iterable[pa.RecordBatch], limits: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Batches of (x, _y, _w, _margin) as rows of bytes, each a block."""
    kept, rows = [], 0

    def block() -> pa.RecordBatch:
        bins, *rest = (np.concatenate(part, axis=-1) for part in zip(*kept))
        return pa.RecordBatch.from_pydict({k: [np.ascontiguousarray(v).tobytes()] for k, v in zip(Block._fields, (bins, *rest))})

    for b in batches:
        y, w, margin = (b.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (1, 2, 3))
        if np.isnan(y).any():
            raise ValueError("labels must not be null or NaN")
        x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), len(limits))
        kept.append((np.stack([np.searchsorted(t, x[:, f]) for f, t in enumerate(limits)]).astype(np.uint8), y, w, margin))
        rows += len(y)
        if rows >= BLOCK:
            yield block()
            kept, rows = [], 0
    if rows:
        yield block()


def narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type: every job reads the blocks again."""
    for kind in (np.uint8, np.float32):
        with np.errstate(invalid="ignore", over="ignore"):
            found = values.astype(kind)
        if (found == values).all():
            return found
    return values


def unpack(row, features: int) -> Block:
    y, w, margin = (np.frombuffer(bytes(row[c])) for c in Block._fields[1:])
    return Block(np.frombuffer(bytes(row["bins"]), np.uint8).reshape(features, -1), narrow(y), narrow(w), margin)


def histograms(blocks: Iterable[Block], tree: Binned, slots: np.ndarray, levels: int, centre: np.ndarray, width: int, kinds: int,
               counted: bool, steps: Iterable[tuple[Binned, np.ndarray]] = (), depth: int = 0) -> list[tuple]:
    """Sums over rows by the open nodes they come to after so many levels: ``slots`` has the slot of an open node, else -1;
    ``width``: bins of a feature; ``steps``: trees (of so much ``depth``) that the margins lack, added to those of the
    rows that count.

    By (node, feature, bin): weights, gradients, with 3 ``kinds`` hessians, if ``counted`` rows; by node: hessians and
    squared gradients, all but the rows weighted.  Gradients are taken from their node's ``centre``, so that rounding
    doesn't look like variance."""
    cells = by_node = None
    for b in blocks:
        live, at = tree.arrived(b.bins, levels, slots)
        if not len(live):
            continue
        if len(live) < len(b.y):
            b = Block(b.bins.take(live, axis=1), b.y[live], b.w[live], b.margin[live])
        bins, y, w, margin = stepped(b, steps, depth)
        y, w = y.astype(np.float64), w.astype(np.float64)
        with np.errstate(over="ignore"):
            p = 1.0 / (1.0 + np.exp(-margin))
        g, h = y - p - centre[at], w * (p * (1.0 - p))
        if cells is None:
            cells, by_node = np.zeros((3 + counted, len(centre), len(bins), width)), np.zeros((2, len(centre)))
        weighted = w * g
        by_node += [np.bincount(at, h, len(centre)), np.bincount(at, weighted * g, len(centre))]
        sums = dict(enumerate((w, weighted, h)[:kinds])) | ({3: None} if counted else {})
        at = at * width
        for f in range(len(bins)):
            cell = at + bins[f]
            for k, v in sums.items():
                cells[k, :, f] += np.bincount(cell, v, len(centre) * width).reshape(-1, width)
    return [] if cells is None else [(cells, by_node)]


class Sums(NamedTuple):
    """Of one node: those of ``histograms``, gradients taken from ``centre``; ``size`` is that of the terms in ``squares``."""
    cells: np.ndarray
    hessian: float
    squares: float
    size: float
    centre: float


def joined(parts: list[Sums], centre: float) -> Sums:
    """Sums of a node from those of its children."""
    cells, hessian, squares, size = 0.0, 0.0, 0.0, 0.0
    for part in parts:
        shift = part.centre - centre
        moved = part.cells.copy()
        moved[1] += shift * moved[0]
        weight, gradient = part.cells[:2, 0].sum(axis=-1)
        cells, hessian, size = cells + moved, hessian + part.hessian, size + part.size + shift ** 2 * weight
        squares += part.squares + 2.0 * shift * gradient + shift ** 2 * weight
    return Sums(cells, hessian, squares, size, centre)


def added(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1]


def best_splits(cells: np.ndarray, min_instances: int) -> tuple[np.ndarray, np.ndarray]:
    """(gain, bin) by node and feature: the split with the largest loss of variance, the first of equal ones; a gain of 0
    or less is no split."""
    below = np.cumsum(cells, axis=-1)
    left, every = below[..., :-1], below[..., -1:]
    right = every - left
    fits = (left[0] > 0) & (right[0] > 0)
    if min_instances > 1:
        fits &= (left[-1] >= min_instances) & (right[-1] >= min_instances)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - every[1] ** 2 / every[0]) / every[0]
    gain = np.where(fits, gain, -np.inf)
    return gain.max(axis=-1), gain.argmax(axis=-1)


class Growing:
    """A tree on bin numbers while its splits are chosen.  A node's ``path`` stands for the splits above it, its ``hints``
    are splits that promised most there."""

    def __init__(self, width: int):
        self.width, self.feature, self.cut, self.child, self.level, self.centre, self.value = width, [], [], [], [], [], []
        self.path, self.hints = [], []
        self.add(0, 0.0, 0, [])

    def add(self, level: int, centre: float, path: int, hints: list) -> None:
        self.feature.append(0), self.cut.append(self.width), self.child.append(len(self.child))
        self.level.append(level), self.centre.append(centre), self.value.append(0.0)
        self.path.append(path), self.hints.append(hints)

    def split(self, node: int, feature: int, cut: int, centres: list[float], hints: list) -> None:
        """Gives a node its split; children that it has by the same split stay."""
        if self.child[node] == node or (self.feature[node], self.cut[node]) != (feature, cut):
            self.feature[node], self.cut[node], self.child[node] = feature, cut, len(self.child)
            for side, c in enumerate(centres):
                self.add(self.level[node] + 1, c, hash((self.path[node], feature, cut, side)), hints)

    def leaf(self, node: int) -> None:
        self.feature[node], self.cut[node], self.child[node] = 0, self.width, node

    def children(self, node: int) -> list[int]:
        return [] if self.child[node] == node else [self.child[node], self.child[node] + 1]

    def guess(self, node: int, seen: dict, deepest: int) -> list[int]:
        """Splits a node and those below it, down to a level, as the last tree with the same splits above did, else by the
        hints.  Returns them all, a node before its children."""
        found = [node]
        for n in found:
            self.centre[n], *split = seen.get(self.path[n], (self.centre[n], -1, 0))
            hints = self.hints[n]
            if split[0] < 0 and hints:
                split, hints = hints[0], hints[1:]
            if split[0] >= 0 and self.level[n] < deepest:
                self.split(n, *split, [self.centre[n]] * 2, hints)
                found += self.children(n)
        return found

    def compact(self) -> Growing:
        """A copy without the nodes that nothing leads to."""
        out = Growing(self.width)
        pairs = [(0, 0)]
        for old, new in pairs:
            if self.children(old):
                out.split(new, self.feature[old], self.cut[old], [0.0, 0.0], [])
                pairs += zip(self.children(old), out.children(new))
            out.value[new] = self.value[old]
        return out

    def binned(self) -> Binned:
        return Binned(*(np.array(x) for x in (self.feature, self.cut, self.child)))

    def tree(self, limits: list[np.ndarray]) -> Tree:
        rows: list[list] = []

        def write(node: int) -> int:
            here = len(rows)
            rows.append([-1, 0.0, -1, -1, self.value[node]])
            if self.children(node):
                f = self.feature[node]
                rows[here] = [f, float(limits[f][self.cut[node]]), -1, -1, 0.0]
                rows[here][2:4] = [write(c) for c in self.children(node)]
            return here

        write(0)
        return tree_of([tuple(r) for r in rows])


def stepped(block: Block, steps: Iterable[tuple[Binned, np.ndarray]], depth: int) -> Block:
    """A block with its margins after further trees."""
    margin = block.margin
    for tree, values in steps:
        margin = margin + values[tree.reached(block.bins, depth)]
    return block._replace(margin=margin)


def grow(blocks: RDD, width: int, depth: int, l2: float, min_instances: int, seen: dict,
         steps: Iterable[tuple[Binned, np.ndarray]] = ()) -> Growing:
    """One tree on the blocks.  A job adds up the sums of the open nodes and of guessed nodes below them: rows are counted
    at the lowest ones, whose sums give those above.  Where the guessed splits prove to be the best ones, the nodes below
    need no job of their own; the others are open in the next job.  ``seen``: (centre, feature, bin) of the nodes of the
    trees before, by path; a guess never changes the tree.  ``steps``: trees that the blocks' margins lack; a job walks
    them with the rows that it counts alone."""
    tree, opened, counted, few = Growing(width), [0], min_instances > 1, blocks.getNumPartitions() <= 64

    def newton(g: float, h: float) -> float:
        return float(g / (h + l2)) if h + l2 > 0 else 0.0

    while opened:
        nodes = [n for node in opened for n in tree.guess(node, seen, depth - 1)]
        lowest = [n for n in nodes if not tree.children(n)]
        slots, centres = np.full(len(tree.level), -1), np.array([tree.centre[n] for n in lowest])
        slots[lowest] = np.arange(len(lowest))
        levels = [tree.level[n] for n in lowest]
        found = blocks.mapPartitions(lambda it, a=(tree.binned(), slots, max(levels), centres, width, 2 + (depth - 1 in levels), counted,
                                                 tuple(steps), depth):
                                     histograms(it, *a))
        cells, (hessian, squares) = (reduce(added, found.collect()) if few else found.treeReduce(added))  # a row a task
        sums = {n: Sums(cells[:, s], hessian[s], squares[s], squares[s], centres[s]) for s, n in enumerate(lowest)}
        for n in reversed(nodes):
            if n not in sums:
                sums[n] = joined([sums[c] for c in tree.children(n)], tree.centre[n])
        cells = np.stack([sums[n].cells for n in nodes], axis=1)
        weight, total = cells[:2, :, 0].sum(axis=-1)
        with np.errstate(divide="ignore", invalid="ignore"):
            pure = (np.array([sums[n].squares for n in nodes]) - total ** 2 / weight
                    < np.maximum(PURE * weight, ROUNDING * np.array([sums[n].size for n in nodes])))
        gains, cuts = best_splits(cells, min_instances)
        slot, todo, opened = {n: s for s, n in enumerate(nodes)}, opened, []
        for node in todo:
            if node not in slot:
                opened.append(node)
                continue
            s, split, here = slot[node], (-1, 0), tree.centre[node]
            tree.value[node] = newton(total[s] + here * weight[s], sums[node].hessian)
            order = np.argsort(-gains[s], kind="stable")
            if tree.level[node] >= depth or gains[s][order[0]] <= 0 or pure[s]:
                tree.leaf(node)
            else:
                hints = [(int(f), int(cuts[s][f])) for f in order if gains[s][f] > 0]
                split, bins, last = hints[0], cells[:3, s, order[0]], tree.level[node] == depth - 1
                sides = [part.sum(axis=-1) for part in (bins[:, :split[1] + 1], bins[:, split[1] + 1:])]
                tree.split(node, *split, [here + g / w for w, g, _ in sides], hints[1:])
                if last:
                    for c, (w, g, h) in zip(tree.children(node), sides):
                        tree.value[c] = newton(g + here * w, h)
                else:
                    todo += tree.children(node)
            seen.pop(tree.path[node], None)
            seen[tree.path[node]] = (here + total[s] / weight[s] if weight[s] > 0 else 0.0, *split)
    while len(seen) > SEEN:
        del seen[next(iter(seen))]
    return tree.compact()


def trees_of_histograms(d: DataFrame, features: int, rate: float, depth: int, l2: float, min_instances: int) -> Iterator[Tree]:
    """Tree after tree on ``d`` (_features, _margin, _w, _y)."""
    n, weight = d.agg(F.count(F.lit(1)), F.sum("_w")).first()
    if not n:
        raise ValueError("no rows to train on")
    limits = bin_limits(d, n, weight, features)
    rows = d.select(vector_to_array("_features").alias("x"), "_y", "_w", "_margin")
    packed = rows.mapInArrow(lambda batches: pack(batches, limits), ", ".join(f"{c} binary" for c in Block._fields)).rdd
    few, most = (-(-n // k) for k in TASK_ROWS)
    tasks = max(min(few, d.sparkSession.sparkContext.defaultParallelism), most)
    blocks = packed.coalesce(tasks).map(lambda row: unpack(row, features)).persist(StorageLevel.MEMORY_AND_DISK)
    done, steps, seen, width = 0, [], {}, max(2, *(len(t) + 1 for t in limits))
    kept = [blocks]  # the last stored blocks; those before go once a job has stored the new ones
    try:
        while True:
            tree = grow(kept[-1], width, depth, l2, min_instances, seen, steps)
            while len(kept) > 1:
                kept.pop(0).unpersist()
            yield tree.tree(limits)
            done += 1
            steps.append((tree.binned(), rate * np.array(tree.value)))
            if done % MARGINS_EVERY == 0:
                kept.append(kept[-1].map(lambda b, s=tuple(steps): stepped(b, s, depth)).persist(StorageLevel.MEMORY_AND_DISK))
                steps = []
                if done % KEEP_EVERY == 0:
                    kept[-1].checkpoint()
    finally:
        for b in kept:
            b.unpersist()


def trees_of_fits(d: DataFrame, rate: float, depth: int, l2: float, min_instances: int, bagging: float) -> Iterator[Tree]:
    """Tree after tree on ``d`` (_features, _margin, _w, _y, _id), each a ``spark.ml`` fit on bootstrapped weights."""
    learner = DecisionTreeRegressor(featuresCol="_features", labelCol="_g", weightCol="_seen", maxDepth=depth, seed=SEED,
                                    minInstancesPerNode=min_instances, predictionCol="_t", leafCol="_leaf")
    gradient = F.col("_y") - F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
    done = 0
    while True:
        u = (F.pmod(F.xxhash64("_id", F.lit(done), F.lit(SEED)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
        seen = F.col("_w") * F.pow(-F.log(u), F.lit(float(bagging)))
        fitted = learner.fit(d.select("_features", gradient.alias("_g"), seen.alias("_seen")))
        tree = parse_tree(fitted.toDebugString)
        d = fitted.transform(d).drop("_t")
        sums = {int(r["_leaf"]): r["value"] for r in leaf_values(d, "_leaf", "_margin", "_y", "_w", l2).collect()}  # a row a leaf
        values = [sums.get(i, 0.0) for i in range(len(tree.leaves))]
        step = F.element_at(F.array(*[F.lit(rate * x) for x in values]), F.col("_leaf").cast("int") + 1)
        d = d.withColumn("_margin", F.col("_margin") + step).drop("_leaf")
        done += 1
        if done % STORE_EVERY == 0:
            d = d.checkpoint(eager=True)
        yield tree.with_leaves(values)


def boost(train: DataFrame, validation: DataFrame | None, features: list[str], label: str = LABEL, rounds: int = 10,
          rate: float = 0.1, depth: int = 3, weight: float = 1.0, l2: float = 3.0, patience: int | None = 50,
          start: Boosted | None = None, min_instances: int = 1, bagging: float = 0.0) -> tuple[Boosted, dict]:
    """Fit up to ``rounds`` trees, after those of ``start`` if it's given.

    ``bagging``: temperature of the Bayesian bootstrap: to choose its splits, a tree sees every row with its weight
    times (-ln u) ** bagging, u a hash of row and round; leaves are fitted to the plain weights.

    Returns the ensemble, cut after its best round, and {rounds_run, best_round, best_auc, start_auc, history}.
    Without ``validation`` rows (or if they're all of one class) all rounds are kept."""
    ensure_checkpoint_dir(train.sparkSession)
    earlier = start or Boosted(features, [], [])
    y = F.col(label).cast("double")
    weights = F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0))
    kept = train.withColumn("_margin", earlier.margin(train)).withColumn("_w", weights)
    inputs = [f"_f{i}" for i in range(len(features))]
    assembler = VectorAssembler(inputCols=inputs, outputCol="_features")
    kept = kept.withColumns({i: _present(F.col(f"`{c}`").cast("double")) for i, c in zip(inputs, features)})
    d = assembler.transform(kept).select("_features", "_margin", "_w", y.alias("_y"), F.monotonically_increasing_id().alias("_id"))
    # every round reads these rows some ten times: use all cores, however few partitions they came in
    cores = train.sparkSession.sparkContext.defaultParallelism
    d = (d.repartition(cores) if d.rdd.getNumPartitions() < cores else d).checkpoint(eager=True)
    v, start_auc = None, None
    if validation is not None:
        v = validation.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], y.alias("_y"), earlier.margin(validation).alias("_margin"))
        v = v.checkpoint(eager=True)
        held = v.count()
        start_auc = staged_auc(v.select("_y", F.array("_margin").alias("m")), "m", "_y").first()["roc_auc"] if earlier.trees else None
    trees, history, best, done = [], [], 0, False
    grown = (trees_of_fits(d, rate, depth, l2, min_instances, bagging) if bagging
             else trees_of_histograms(d, len(features), rate, depth, l2, min_instances))
    while len(trees) < rounds and not done:
        trees.append(next(grown))
        if v is not None and (len(trees) == rounds or len(trees) % EVERY == 0 and (
                len(trees) - best >= (rounds if patience is None else patience) or (len(trees) + EVERY - len(history)) * held > LOOK)):
            new = Boosted(features, trees[len(history):], [rate] * (len(trees) - len(history)))
            staged = v.select("_y", *features, "_margin", new.staged_margins(v).alias("_new"))
            staged = staged.withColumn("_stages", F.transform("_new", lambda x: x + F.col("_margin"))).checkpoint(eager=True)
            ranges = max(1, min(shuffle_partitions(v), held * len(new.trees) // RANGE_ROWS))
            found = {r["stage"]: r["roc_auc"] for r in staged_auc(staged, "_stages", "_y", ranges).collect()}  # a row a round
            history += [found.get(i) for i in range(1, len(new.trees) + 1)]
            v = staged.withColumn("_margin", F.element_at("_stages", -1)).drop("_new", "_stages")
            best, done = best_round(history, patience, start_auc)
    grown.close()
    measured = any(a is not None for a in history)
    keep = best if measured else len(trees)
    model = Boosted(features, earlier.trees + trees[:keep], earlier.rates + [rate] * keep)
    top = max([a for a in [start_auc, *history] if a is not None], default=None)
    return model, {"rounds_run": len(trees), "best_round": keep, "best_auc": top, "start_auc": start_auc, "history": history}
