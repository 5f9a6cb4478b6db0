"""Boosted trees with regularised leaves against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import boosting as bo
from riskframe.operators import metrics as me


def table(spark, n=1500, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + 0.8 * rng.normal(size=n) > 0.9).astype(int)
    rows = [(i, float(a), float(b), float(c), int(t)) for i, ((a, b, c), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, is_fraud int").checkpoint(), x, y


def pair_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def by_hand(tree, x):
    out = []
    for row in x:
        node = 0
        while tree.feature[node] >= 0:
            node = tree.left[node] if row[tree.feature[node]] <= tree.threshold[node] else tree.right[node]
        out.append(node)
    return np.array(out)


def test_staged_auc_equals_pair_counting_for_every_prefix(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.2).astype(int)
    s = np.round(rng.normal(size=(400, 6)) + y[:, None] * np.linspace(0, 1, 6), 1)  # with ties
    df = spark.createDataFrame([(int(t), [float(v) for v in r]) for t, r in zip(y, s)] + [(None, [9.0] * 6)], "y int, m array<double>")
    got = {r["stage"]: r["roc_auc"] for r in me.staged_auc(df, "m", "y").collect()}
    assert got == pytest.approx({i + 1: pair_auc(y, s[:, i]) for i in range(6)}, abs=1e-12)
    one = me.staged_auc(df.where("y = 0"), "m", "y").collect()
    assert len(one) == 6 and all(r["roc_auc"] is None for r in one)


def test_boosting_matches_numpy_and_stops_at_the_best_auc(spark):
    df, x, y = table(spark)
    fit, held = df.where("k % 3 <> 0"), df.where("k % 3 = 0")
    model, info = bo.boost(fit, held, ["a", "b", "c"], rounds=25, rate=0.4, depth=2, weight=3.0, l2=4.0, patience=5)
    at = np.arange(len(x)) % 3 != 0
    w = np.where(y == 1, 3.0, 1.0)
    margin, aucs = np.zeros(len(x)), []
    for tree, rate in zip(model.trees, model.rates):
        leaf = by_hand(tree, x)
        p = 1 / (1 + np.exp(-margin))
        for n in tree.leaves:
            here = at & (leaf == n)
            value = (w * (y - p))[here].sum() / ((w * p * (1 - p))[here].sum() + 4.0)
            assert abs(tree.value[n] - value) < 1e-9
        margin = margin + rate * tree.value[leaf]
        aucs.append(pair_auc(y[~at], margin[~at]))
    history = info["history"]
    assert history[:len(aucs)] == pytest.approx(aucs, abs=1e-12)
    best = int(np.argmax(history)) + 1
    stop = next((i for i in range(1, len(history) + 1) if i - (int(np.argmax(history[:i])) + 1) >= 5), None)
    if stop:
        best = int(np.argmax(history[:stop])) + 1
        assert info["rounds_run"] < stop + bo.EVERY
    assert info["best_round"] == len(model.trees) == best and info["best_auc"] >= 0.7
    scored = {r["k"]: r["probability"][1] for r in model.transform(df.withColumn("extra", F.lit("x"))).collect()}
    assert max(abs(scored[i] - 1 / (1 + np.exp(-margin[i]))) for i in range(len(x))) < 1e-9


@pytest.mark.parametrize("history, patience, start, want", [
    ([0.5, 0.6, 0.6, 0.55], 2, None, (2, True)), ([0.5, 0.6, 0.6], 2, None, (2, False)), ([0.5, 0.4], 2, 0.7, (0, True)),
    ([None, None], 5, None, (0, False)), ([0.6, 0.5, 0.9], 2, None, (3, False)), ([], 3, None, (0, False))])
def test_best_round(history, patience, start, want):
    assert bo.best_round(history, patience, start) == want


def test_more_regularisation_makes_smaller_leaves_and_bagging_other_trees(spark):
    df, *_ = table(spark, 600)
    trees = {}
    for l2, bagging in ((0.0, 0.0), (10.0, 0.0), (10.0, 1.0)):
        model, info = bo.boost(df, None, ["a", "b", "c"], rounds=2, depth=2, l2=l2, bagging=bagging)
        assert info["rounds_run"] == info["best_round"] == 2 and info["history"] == []
        trees[l2, bagging] = model.trees
    plain, small, bagged = trees.values()
    assert np.abs(small[0].value).max() < np.abs(plain[0].value).max()
    assert (small[0].threshold != bagged[0].threshold).any()
    again, _ = bo.boost(df, None, ["a", "b", "c"], rounds=2, depth=2, l2=10.0, bagging=1.0)
    assert all((a.value == b.value).all() for a, b in zip(bagged, again.trees))


def test_missing_values_and_labels_of_one_class(spark):
    rows = spark.createDataFrame([(float(i), None if i % 4 == 0 else float(i % 7), i % 2) for i in range(80)], "a double, b double, is_fraud int")
    model, info = bo.boost(rows, rows.where("is_fraud = 0"), ["a", "b"], rounds=3, depth=2)
    assert info["best_round"] == 3 and info["best_auc"] is None  # no AUC to go by
    assert model.transform(rows).where("isnan(_margin) or _margin is null").count() == 0
    tree = bo.tree_of([(0, -5.0, 1, 2, 0.0), (-1, 0, -1, -1, 1.0), (-1, 0, -1, -1, 2.0)])
    odd = spark.createDataFrame([(0, None), (1, float("nan")), (2, float("-inf")), (3, float("inf")), (4, 1.0)], "k int, a double")
    got = odd.select("k", bo.Boosted(["a"], [tree], [1.0]).margin(odd).alias("m")).orderBy("k").collect()
    assert [r["m"] for r in got] == [1.0, 1.0, 1.0, 2.0, 2.0]  # a missing value is the least


def test_printed_trees_are_read_back():
    text = """DecisionTreeRegressionModel: uid=x, depth=2, numNodes=5, numFeatures=2
  If (feature 1 <= -1.5E-7)
   Predict: -0.25
  Else (feature 1 > -1.5E-7)
   If (feature 0 <= 3.0)
    Predict: 1.0E-4
   Else (feature 0 > 3.0)
    Predict: 7.0
"""
    tree = bo.parse_tree(text)
    assert tree.feature.tolist() == [1, -1, 0, -1, -1] and tree.threshold[[0, 2]].tolist() == [-1.5e-7, 3.0]
    assert tree.left[[0, 2]].tolist() == [1, 3] and tree.right[[0, 2]].tolist() == [2, 4] and tree.value[[1, 3, 4]].tolist() == [-0.25, 1e-4, 7.0]
    with pytest.raises(ValueError):
        bo.parse_tree(text.replace("<= 3.0", "in {1.0}"))


def test_a_round_takes_a_job_a_level_at_most(spark):
    """Findings of round 3 (F1, F2): a round took nine jobs here, and made the bins anew."""
    df, *_ = table(spark, 600)
    jobs = []
    for rounds in (4, 12):
        spark.sparkContext.setJobGroup(f"boosting-{rounds}", "")
        _, info = bo.boost(df, None, ["a", "b", "c"], rounds=rounds, depth=4)
        assert info["rounds_run"] == rounds
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boosting-{rounds}")))
    spark.sparkContext.setJobGroup("", "")
    assert 0 < jobs[1] - jobs[0] <= 8 * 4


def one_by_one(df, n, trees):
    """Rows as boosting keeps them, and the trees of both ways to grow them."""
    rows = bo.VectorAssembler(inputCols=["a", "b", "c"], outputCol="_features").transform(df)
    rows = rows.select("_features", F.lit(0.0).alias("_margin"), F.expr("if(is_fraud = 1, 3D, 1D)").alias("_w"),
                       F.col("is_fraud").cast("double").alias("_y"), F.col("k").alias("_id")).repartition(4).checkpoint()
    out = []
    for grown in (bo.trees_of_histograms(rows, 3, 0.3, 4, 2.0, n), bo.trees_of_fits(rows, 0.3, 4, 2.0, n, 0.0)):
        out.append([next(grown) for _ in range(trees)])
        grown.close()
    return out


@pytest.mark.parametrize("n, rows", [(1, 1500), (40, 1500), (1, 23000)])
def test_histograms_choose_the_splits_of_spark_ml(spark, n, rows):
    df, *_ = table(spark, rows)
    for here, there in zip(*one_by_one(df, n, 1)):
        assert here.feature.tolist() == there.feature.tolist() and here.threshold.tolist() == there.threshold.tolist()
        assert np.abs(here.value - there.value)[here.leaves].max() < 1e-9


def test_rows_of_one_gradient_stay_together(spark):
    rows = spark.createDataFrame([(i, i / 7, i % 20 / 3, 0.1, int(i % 20 > 16)) for i in range(3000)], "k long, a double, b double, c double, is_fraud int")
    here, _ = one_by_one(rows.checkpoint(), 1, 4)
    assert [t.feature.tolist() for t in here] == [[1, -1, -1]] * 4  # b tells all; rounding splits no further
    assert all(bo.limits_of(v, np.ones(len(v)), len(v), len(v)) == w for v, w in [
        (np.array([]), []), (np.array([5.0]), []), (np.array([3.0, 1.0]), [2.0]), (np.arange(1.0, 33.0), (np.arange(1.0, 32.0) + 0.5).tolist())])
    assert bo.limits_of(np.array([2.0]), np.array([1.0]), 1, 4.0) == [1.0]  # the rest of the weight is that of 0
    assert len(bo.limits_of(np.arange(1.0, 1001.0), np.ones(1000), 1000, 1000.0)) == 31


def test_looks_that_cannot_stop_the_boosting_are_taken_together(spark, monkeypatch):
    """Finding F2 of round 3: every 10 rounds the held-out rows were looked at, and every round stored all blocks."""
    df = table(spark, 900)[0].withColumn("is_fraud", F.expr("cast(pmod(xxhash64(k), 4) = 0 as int)"))  # nothing to learn
    fit, held = df.where("k % 3 <> 0").checkpoint(), df.where("k % 3 = 0").checkpoint()
    looks, stored, auc, persist = [], [], bo.staged_auc, bo.RDD.persist
    monkeypatch.setattr(bo, "staged_auc", lambda *a, **k: looks.append(a) or auc(*a, **k))
    monkeypatch.setattr(bo.RDD, "persist", lambda self, *a, **k: stored.append(self) or persist(self, *a, **k))
    found = []
    for most in (0, 1 << 22):
        monkeypatch.setattr(bo, "LOOK", most)
        looks.clear(), stored.clear()
        model, info = bo.boost(fit, held, ["a", "b", "c"], rounds=80, rate=0.5, depth=3, patience=25)
        assert info["rounds_run"] < 80 and info["rounds_run"] % bo.EVERY == 0 and len(info["history"]) == info["rounds_run"]
        assert len(stored) <= 1 + info["rounds_run"] // bo.MARGINS_EVERY
        found.append((info["rounds_run"], info["best_round"], [t.feature.tolist() for t in model.trees], len(looks)))
        assert info["history"] == pytest.approx(info["history"] if not most else first["history"], abs=1e-12)
        first = info
    assert found[0][:3] == found[1][:3] and found[0][3] == found[0][0] // bo.EVERY > found[1][3]


def test_guessed_splits_never_change_a_tree(spark, monkeypatch):
    df, *_ = table(spark, 1200)
    guess, found = bo.Growing.guess, []
    for guessed in (True, False):
        if not guessed:
            monkeypatch.setattr(bo.Growing, "guess", lambda self, node, seen, deepest: guess(self, node, seen, 0))
        model, _ = bo.boost(df, None, ["a", "b", "c"], rounds=8, rate=0.3, depth=4, weight=3.0)
        found.append(model.trees)
    for here, there in zip(*found):
        assert here.feature.tolist() == there.feature.tolist() and here.threshold.tolist() == there.threshold.tolist()
        assert np.abs(here.value - there.value).max() < 1e-9


def test_a_job_walks_the_trees_since_then_with_the_rows_that_it_counts_alone(monkeypatch):
    rng = np.random.default_rng(7)
    n, width, depth = 4000, 8, 4

    def tree():
        grown, todo = bo.Growing(width), [0]
        for node in todo:
            if grown.level[node] < depth:
                grown.split(node, int(rng.integers(3)), int(rng.integers(1, width - 1)), [0.0, 0.0], [])
                todo += grown.children(node)
        return grown

    block = bo.Block(rng.integers(0, width, (3, n)).astype(np.uint8), (rng.random(n) < 0.2).astype(float), rng.choice([1.0, 25.0], n),
                     rng.normal(size=n))
    steps = [(t.binned(), rng.normal(size=len(t.level))) for t in (tree(), tree())]
    grown = tree()
    binned, last = grown.binned(), [i for i, level in enumerate(grown.level) if level == depth]
    met = binned.reached(block.bins, depth)
    walked, reached = [], bo.Binned.reached
    for opened in (last, last[3:5], [i for i in last if not (met == i).any()], [grown.children(0)[0]]):
        levels = max((grown.level[i] for i in opened), default=0)
        slots = np.full(len(grown.level), -1)
        slots[opened] = np.arange(len(opened))
        args = (binned._replace(child=np.where(slots >= 0, np.arange(len(slots)), binned.child),
                                cut=np.where(slots >= 0, width, binned.cut)), slots, levels, np.zeros(len(opened)), width, 3, True)
        rows = np.isin(args[0].reached(block.bins, levels), opened).sum()
        want = bo.histograms([bo.stepped(block, steps, depth)], *args)
        monkeypatch.setattr(bo.Binned, "reached", lambda t, bins, levels: walked.append(bins.shape[1]) or reached(t, bins, levels))
        got = bo.histograms([block], *args, steps, depth)
        monkeypatch.undo()
        assert len(got) == len(want) and all((a == b).all() for x, y in zip(got, want) for a, b in zip(x, y))
        assert walked == [rows] * (2 if rows else 0)
        walked.clear()


def test_labels_and_weights_of_blocks_are_narrow_and_keep_their_values():
    for values, kind in (([0.0, 1.0, 25.0], np.uint8), ([0.5, -1.0, 300.0], np.float32), ([0.1, 1.0], np.float64), ([np.inf], np.float32)):
        found = bo.narrow(np.array(values))
        assert found.dtype == kind and found.astype(np.float64).tolist() == values
    row = {c: np.array(v, t).tobytes() for c, v, t in zip(bo.Block._fields, ([[1, 2]] * 3, [0, 1], [1, 25], [0.5, 0.1]), ("u1", "f8", "f8", "f8"))}
    block = bo.unpack(row, 3)
    assert sum(a.nbytes for a in block) == 6 + 2 + 2 + 16 and block.w.tolist() == [1, 25]
