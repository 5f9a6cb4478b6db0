"""Column drift between a reference table and a current table.

Plan: tag sides, ``unpivot`` every compared column into (column, value),
and aggregate once into a value-count table ``vc(column, value, n_ref,
n_cur)`` (partial aggregation before the shuffle, so hot values are cheap).
``vc`` is checkpointed; every test reads it, never the raw rows:

* per-column summary (sizes, distinct values, range, reference mean/std)
  picks the test per column;
* normed Wasserstein and KS need empirical CDFs: exact running counts come
  from ``running_totals`` (range-split per column, no one-task window);
* Jensen-Shannon, chi-square and Z use value (or bin) counts only.

Summaries are one row per column and stay DataFrames; p-values are Column
expressions over those rows (``functions.stats``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.prefix import running_totals
from riskframe.functions.stats import chi2_sf, ks_p_value, norm_two_sided_p
from riskframe.operators.features import drop_index_columns
from riskframe.session import ensure_checkpoint_dir

# Test names as reported, default thresholds, test-choice limits.
STATTEST_NAMES = {
    "wasserstein": "Wasserstein distance (normed)",
    "jensenshannon": "Jensen-Shannon distance",
    "ks": "K-S p_value",
    "chisquare": "chi-square p_value",
    "z": "Z-test p_value",
}
DISTANCE_TESTS = ("wasserstein", "jensenshannon")
DISTANCE_THRESHOLD = 0.1
P_THRESHOLD = 0.05
LARGE_REFERENCE_ROWS = 1000
FEW_VALUES = 5
JS_NUMERIC_BINS = 30
HIST_BINS = 10
STD_FLOOR = 0.001
DEFAULT_DRIFT_SHARE = 0.2

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _is_numeric(t: str) -> bool:
    return t in NUMERIC_TYPES or t.startswith("decimal")


def value_counts(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
                 materialize: bool = True) -> DataFrame:
    """``vc(column_name, kind, num, cat, n_ref, n_cur)``; NULLs excluded."""
    reference, current = drop_index_columns(reference), drop_index_columns(current)
    columns = columns or [c for c in reference.columns if c in set(current.columns)]
    types = dict(reference.dtypes)
    num_cols = [c for c in columns if _is_numeric(types[c])]
    cat_cols = [c for c in columns if c not in num_cols]
    # one generator per row: a (column, kind, num, cat) struct per compared column,
    # so each input is scanned once for numeric and text columns together
    cells = ([F.struct(F.lit(c).alias("column_name"), F.lit("num").alias("kind"),
                       F.col(c).cast("double").alias("num"), F.lit(None).cast("string").alias("cat"))
              for c in num_cols]
             + [F.struct(F.lit(c).alias("column_name"), F.lit("cat").alias("kind"),
                         F.lit(None).cast("double").alias("num"), F.col(c).cast("string").alias("cat"))
                for c in cat_cols])
    both = (reference.select(F.lit(1).alias("_ref"), F.explode(F.array(*cells)).alias("x"))
            .unionByName(current.select(F.lit(0).alias("_ref"), F.explode(F.array(*cells)).alias("x"))))
    long = both.select("_ref", "x.*").where(F.col("num").isNotNull() | F.col("cat").isNotNull())
    vc = long.groupBy("column_name", "kind", "num", "cat").agg(
        F.sum("_ref").cast("long").alias("n_ref"), F.sum(1 - F.col("_ref")).cast("long").alias("n_cur"))
    if materialize:
        ensure_checkpoint_dir(vc.sparkSession)
        vc = vc.checkpoint(eager=True)
    return vc


def column_summary(vc: DataFrame) -> DataFrame:
    """One row per column: sizes, distinct values, range, reference mean/std."""
    s = vc.groupBy("column_name", "kind").agg(
        F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"), F.count("*").alias("n_distinct"),
        F.min("num").alias("lo"), F.max("num").alias("hi"),
        (F.sum(F.col("num") * F.col("n_ref")) / F.sum("n_ref")).alias("mean_ref"),
        F.min("cat").alias("min_cat"))
    # second pass for a stable population variance (one row per column joined back)
    dev = vc.join(F.broadcast(s.select("column_name", "mean_ref")), "column_name").groupBy("column_name").agg(
        F.sqrt(F.sum(F.col("n_ref") * F.pow(F.col("num") - F.col("mean_ref"), 2)) / F.sum("n_ref")).alias("std_ref"))
    return s.join(F.broadcast(dev), "column_name")  # one row per column on both sides


def choose_test(summary: DataFrame, stattest: str | dict | None = None) -> DataFrame:
    """Add ``test``: by reference size, column kind and distinct values, unless overridden."""
    large = F.col("tot_ref") > LARGE_REFERENCE_ROWS
    few = F.col("n_distinct") <= FEW_VALUES
    small_cat = F.when(F.col("n_distinct") > 2, "chisquare").otherwise("z")
    auto = (F.when(F.col("kind") == "num",
                   F.when(few, F.when(large, "jensenshannon").otherwise(small_cat))
                   .otherwise(F.when(large, "wasserstein").otherwise("ks")))
            .otherwise(F.when(large, "jensenshannon").otherwise(small_cat)))
    if isinstance(stattest, str):
        auto = F.lit(stattest)
    elif isinstance(stattest, dict) and stattest:
        m = F.create_map(*[x for k, v in stattest.items() for x in (F.lit(k), F.lit(v))])
        auto = F.coalesce(m[F.col("column_name")], auto)
    return summary.withColumn("test", auto)


def _cdf_rows(vc: DataFrame, plan: DataFrame, test: str) -> DataFrame:
    sel = plan.where(F.col("test") == test).select("column_name", "tot_ref", "tot_cur", "std_ref")
    rows = vc.where(F.col("kind") == "num").join(F.broadcast(sel), "column_name")
    rt = running_totals(rows, ["column_name"], "num", ["n_ref", "n_cur"], next_col="nxt")
    gap = F.abs(F.col("cum_n_ref") / F.col("tot_ref") - F.col("cum_n_cur") / F.col("tot_cur"))
    return rt.withColumn("gap", gap)


def wasserstein_scores(vc: DataFrame, plan: DataFrame) -> DataFrame:
    """Integral of |F_ref - F_cur| over the value axis, over max(std_ref, 0.001)."""
    r = _cdf_rows(vc, plan, "wasserstein")
    return r.groupBy("column_name").agg(
        (F.sum(F.col("gap") * (F.col("nxt") - F.col("num"))) / F.greatest(F.first("std_ref"), F.lit(STD_FLOOR)))
        .alias("score"))


def ks_statistics(vc: DataFrame, plan: DataFrame) -> DataFrame:
    """max |F_ref - F_cur| over the distinct values."""
    r = _cdf_rows(vc, plan, "ks")
    return r.groupBy("column_name").agg(F.max("gap").alias("stat"))


def _binned(vc: DataFrame, plan: DataFrame, test: str) -> DataFrame:
    """Counts per key: the value for text columns and numeric ones of few values,
    one of 30 common equal-width bins (last closed) for other numeric ones."""
    sel = plan.where(F.col("test") == test).select("column_name", "lo", "hi", "tot_ref", "tot_cur", "n_distinct")
    r = vc.join(F.broadcast(sel), "column_name")
    span = F.col("hi") - F.col("lo")
    b = F.least(F.floor((F.col("num") - F.col("lo")) / span * JS_NUMERIC_BINS), F.lit(JS_NUMERIC_BINS - 1))
    b = F.when(span == 0, F.lit(JS_NUMERIC_BINS // 2)).otherwise(b)
    # few distinct values are categories, numeric or not; bins would join those that lie close together
    key = F.when(F.col("kind") == "cat", F.col("cat")).when(
        F.col("n_distinct") <= FEW_VALUES, F.col("num").cast("string")).otherwise(b.cast("string"))
    return r.groupBy("column_name", key.alias("key"), "tot_ref", "tot_cur").agg(
        F.sum("n_ref").alias("a"), F.sum("n_cur").alias("b"))


def js_scores(vc: DataFrame, plan: DataFrame) -> DataFrame:
    """Jensen-Shannon distance (natural log), no zero filling."""
    k = _binned(vc, plan, "jensenshannon")
    p = F.col("a") / F.col("tot_ref")
    q = F.col("b") / F.col("tot_cur")
    m = (p + q) / 2
    rel = lambda x: F.when(x > 0, x * F.log(x / m)).otherwise(F.lit(0.0))
    return k.groupBy("column_name").agg(
        F.sqrt(F.greatest(F.sum(rel(p) + rel(q)) / 2, F.lit(0.0))).alias("score"))


def chi2_statistics(vc: DataFrame, plan: DataFrame) -> DataFrame:
    """Goodness of fit of current counts to reference counts scaled to the current size."""
    sel = plan.where(F.col("test") == "chisquare").select("column_name", "tot_ref", "tot_cur", "n_distinct")
    r = vc.join(F.broadcast(sel), "column_name")
    exp = F.col("n_ref") * (F.col("tot_cur") / F.col("tot_ref"))
    term = F.when(exp == 0, F.when(F.col("n_cur") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))).otherwise(
        F.pow(F.col("n_cur") - exp, 2) / exp)
    return r.groupBy("column_name").agg(F.sum(term).alias("stat"), (F.first("n_distinct") - 1).alias("dof"))


def z_statistics(vc: DataFrame, plan: DataFrame) -> DataFrame:
    """Two-proportion z for the smallest value of a (at most) two-valued column
    (numeric values order by value, text lexically)."""
    sel = plan.where(F.col("test") == "z").select("column_name", "tot_ref", "tot_cur", "n_distinct")
    r = vc.join(F.broadcast(sel), "column_name")
    g = r.groupBy("column_name", "kind", "tot_ref", "tot_cur", "n_distinct").agg(
        F.min_by(F.struct("n_ref", "n_cur"), "num").alias("tn"),
        F.min_by(F.struct("n_ref", "n_cur"), "cat").alias("tc"))
    t = F.when(F.col("kind") == "num", F.col("tn")).otherwise(F.col("tc"))
    p1 = t["n_ref"] / F.col("tot_ref")
    p2 = t["n_cur"] / F.col("tot_cur")
    pooled = (t["n_ref"] + t["n_cur"]) / (F.col("tot_ref") + F.col("tot_cur"))
    z = (p1 - p2) / F.sqrt(pooled * (1 - pooled) * (1 / F.col("tot_ref") + 1 / F.col("tot_cur")))
    # one shared value on both sides: no difference (p = 1)
    return g.select("column_name", F.when(F.col("n_distinct") == 1, F.lit(0.0)).otherwise(z).alias("stat"))


def p_values(vc: DataFrame, plan: DataFrame, used: set[str] | None = None, exact_ks: bool = True) -> DataFrame:
    """(column_name, test, stat, p_value) of the columns that ``plan`` gives a KS, chi-square or Z test."""
    used = used if used is not None else {r["test"] for r in plan.select("test").distinct().collect()}
    no_dof = F.lit(None).cast("long")
    parts = [fn(vc, plan).select("column_name", F.lit(t).alias("test"), F.col("stat").cast("double").alias("stat"),
                                 (F.col("dof").cast("long") if t == "chisquare" else no_dof).alias("dof"))
             for t, fn in (("ks", ks_statistics), ("chisquare", chi2_statistics), ("z", z_statistics)) if t in used]
    if not parts:
        return vc.sparkSession.createDataFrame([], "column_name string, test string, stat double, p_value double")
    stats = parts[0]
    for x in parts[1:]:
        stats = stats.unionByName(x)
    # a row per column on both sides; the statistics are stored, so that no p-value computes them again
    stats = stats.join(F.broadcast(plan.select("column_name", "tot_ref", "tot_cur")), "column_name").checkpoint(eager=True)
    p = (F.when(F.col("test") == "chisquare", chi2_sf(F.col("stat"), F.col("dof")))
         .when(F.col("test") == "z", norm_two_sided_p(F.col("stat")))
         .otherwise(ks_p_value(F.when(F.col("test") == "ks", F.col("stat")), F.col("tot_ref"), F.col("tot_cur"), exact_ks)))
    return stats.select("column_name", "test", "stat", p.alias("p_value"))


def drift_table(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
                stattest: str | dict | None = None, threshold: float | None = None,
                vc: DataFrame | None = None) -> DataFrame:
    """Per-column result: name, type, test, threshold, score, drift flag."""
    vc = vc if vc is not None else value_counts(reference, current, columns)
    plan = choose_test(column_summary(vc), stattest)
    plan = plan.checkpoint(eager=True)  # one row per column
    # only the tests some column uses are computed (at most five names)
    used = {r["test"] for r in plan.select("test").distinct().collect()}
    dist_parts = [fn(vc, plan).withColumn("test", F.lit(t))
                  for t, fn in (("wasserstein", wasserstein_scores), ("jensenshannon", js_scores)) if t in used]
    parts = [d.select("column_name", "test", F.col("score").cast("double").alias("score")) for d in dist_parts]
    if used & {"ks", "chisquare", "z"}:
        parts.append(p_values(vc, plan, used).select("column_name", "test", F.col("p_value").alias("score")))
    if parts:
        allsc = parts[0]
        for x in parts[1:]:
            allsc = allsc.unionByName(x)
    else:
        allsc = vc.sparkSession.createDataFrame([], "column_name string, test string, score double")
    names = F.create_map(*[x for k, v in STATTEST_NAMES.items() for x in (F.lit(k), F.lit(v))])
    is_dist = F.col("test").isin(*DISTANCE_TESTS)
    thr = F.lit(threshold) if threshold is not None else F.when(is_dist, F.lit(DISTANCE_THRESHOLD)).otherwise(
        F.lit(P_THRESHOLD))
    # per-column tables on both sides: bounded by the column count
    out = plan.select("column_name", "kind", "test").join(F.broadcast(allsc), ["column_name", "test"], "left")
    out = out.withColumn("stattest_threshold", thr.cast("double"))
    flag = F.when(is_dist, F.col("score") >= F.col("stattest_threshold")).otherwise(
        F.col("score") < F.col("stattest_threshold"))
    return out.select("column_name", F.col("kind").alias("column_type"), names[F.col("test")].alias("stattest_name"),
                      "stattest_threshold", F.col("score").alias("drift_score"),
                      F.coalesce(flag, F.lit(False)).alias("drift_detected"))


def drift_verdict(table: DataFrame, drift_share: float = DEFAULT_DRIFT_SHARE) -> DataFrame:
    """Dataset verdict: share of drifted columns against ``drift_share``."""
    a = table.agg(F.count("*").cast("int").alias("n_columns"),
                  F.sum(F.col("drift_detected").cast("int")).cast("int").alias("n_drifted"),
                  F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("column_name"))))
                  .alias("drifted_columns"))
    share = F.col("n_drifted") / F.col("n_columns")
    return a.select("n_columns", "n_drifted", share.alias("share"), F.lit(float(drift_share)).alias("drift_share"),
                    (share >= F.lit(float(drift_share))).alias("dataset_drift"), "drifted_columns")


def drift_histograms(vc: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """10-bin density histogram per numeric column and side, on the side's own
    range (last bin closed; a constant side gets the range value +/- 0.5)."""
    num = vc.where(F.col("kind") == "num")
    sides = num.select("column_name", "num", F.lit("reference").alias("side"), F.col("n_ref").alias("c")).unionByName(
        num.select("column_name", "num", F.lit("current").alias("side"), F.col("n_cur").alias("c"))).where("c > 0")
    rng = sides.groupBy("column_name", "side").agg(F.min("num").alias("mn"), F.max("num").alias("mx"),
                                                    F.sum("c").alias("n"))
    rng = rng.select("column_name", "side", "n",
                     F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                     F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    # one row per (column, side): bounded by twice the column count
    j = sides.join(F.broadcast(rng), ["column_name", "side"])
    b = F.least(F.floor((F.col("num") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    cnt = j.groupBy("column_name", "side", b.cast("int").alias("bin")).agg(F.sum("c").alias("k"))
    grid = rng.select("column_name", "side", "n", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / bins
    # at most columns x 2 sides x bins rows
    return grid.join(F.broadcast(cnt), ["column_name", "side", "bin"], "left").select(
        "column_name", "side", "bin", (F.col("lo") + F.col("bin") * w).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
        (F.coalesce(F.col("k"), F.lit(0)) / (F.col("n") * w)).alias("density"))


def monitor(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
            drift_share: float = DEFAULT_DRIFT_SHARE, key: str | None = None, ratio: int | None = 5,
            stattest: str | dict | None = None, seed: int = 42) -> dict:
    """Full drift run: strip index columns, optionally down-sample the
    reference to ``ratio`` x current (needs a unique ``key``), then the
    per-column table, dataset verdict and histograms."""
    from riskframe.operators.sampling import balanced_reference
    reference, current = drop_index_columns(reference), drop_index_columns(current)
    if key and ratio:
        reference = balanced_reference(reference, current, key, ratio, seed)
    cols = columns or [c for c in reference.columns if c in set(current.columns) and c != key]
    vc = value_counts(reference, current, cols)
    table = drift_table(reference, current, cols, stattest=stattest, vc=vc).checkpoint(eager=True)
    return {"table": table, "verdict": drift_verdict(table, drift_share), "histograms": drift_histograms(vc)}
