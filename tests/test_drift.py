import math

from pyspark.sql import functions as F

from riskframe.functions import stats
from riskframe.operators import drift as dr


def _table(d):
    return {r["column_name"]: r for r in d.collect()}


def test_disjoint_two_value_supports_give_sqrt_ln2(spark):
    # golden: the stored report's gender score
    ref = spark.createDataFrame([(0.1,)] * 700 + [(0.2,)] * 600, "g double")
    cur = spark.createDataFrame([(0.05,)] * 800 + [(0.3,)] * 900, "g double")
    t = _table(dr.drift_table(ref, cur))
    assert t["g"]["stattest_name"] == "Jensen-Shannon distance"
    assert abs(t["g"]["drift_score"] - 0.8325546111576977) < 1e-12
    assert t["g"]["drift_detected"]


def test_identical_tables_do_not_drift(spark):
    df = spark.range(2000).select((F.col("id") % 97).cast("double").alias("x"),
                                  (F.col("id") % 3).cast("string").alias("c"))
    t = _table(dr.drift_table(df, df))
    assert t["x"]["stattest_name"] == "Wasserstein distance (normed)" and abs(t["x"]["drift_score"]) < 1e-12
    assert t["c"]["stattest_name"] == "Jensen-Shannon distance" and abs(t["c"]["drift_score"]) < 1e-12
    v = dr.drift_verdict(dr.drift_table(df, df)).first()
    assert v["n_drifted"] == 0 and not v["dataset_drift"]


def _wasserstein(u, v):
    xs = sorted(set(u) | set(v))
    tot = 0.0
    for a, b in zip(xs, xs[1:]):
        fu = sum(1 for x in u if x <= a) / len(u)
        fv = sum(1 for x in v if x <= a) / len(v)
        tot += abs(fu - fv) * (b - a)
    return tot


def test_wasserstein_normed_brute_force(spark):
    u = [float((i * 7) % 50) for i in range(1200)]
    v = [float((i * 11) % 60) + 0.5 for i in range(900)]
    ref = spark.createDataFrame([(x,) for x in u], "x double")
    cur = spark.createDataFrame([(x,) for x in v], "x double")
    mean = sum(u) / len(u)
    std = math.sqrt(sum((x - mean) ** 2 for x in u) / len(u))
    exp = _wasserstein(u, v) / max(std, 0.001)
    assert abs(_table(dr.drift_table(ref, cur))["x"]["drift_score"] - exp) < 1e-9


def test_small_sample_tests(spark):
    ref = spark.createDataFrame([(float(i % 40), ["a", "b", "c"][i % 3], ["M", "F"][i % 2]) for i in range(300)],
                                "x double, c string, g string")
    cur = spark.createDataFrame([(float(i % 40) + (i % 5), ["a", "b", "c", "c"][i % 4], ["M", "F", "F"][i % 3])
                                 for i in range(250)], "x double, c string, g string")
    t = _table(dr.drift_table(ref, cur))
    assert t["x"]["stattest_name"] == "K-S p_value"
    assert t["c"]["stattest_name"] == "chi-square p_value"
    assert t["g"]["stattest_name"] == "Z-test p_value"
    # chi-square by hand
    from collections import Counter
    ref_c = Counter(["a", "b", "c"][i % 3] for i in range(300))
    cur_c = Counter(["a", "b", "c", "c"][i % 4] for i in range(250))
    k = 250 / 300
    chi = sum((cur_c[x] - ref_c[x] * k) ** 2 / (ref_c[x] * k) for x in ref_c)
    assert abs(t["c"]["drift_score"] - math.exp(-chi / 2)) < 1e-12  # two degrees of freedom
    # z test by hand on the smallest value 'F'
    nf = sum(1 for i in range(250) if ["M", "F", "F"][i % 3] == "F")
    p1, p2 = 150 / 300, nf / 250
    pp = (150 + nf) / 550
    z = (p1 - p2) / math.sqrt(pp * (1 - pp) * (1 / 300 + 1 / 250))
    assert abs(t["g"]["drift_score"] - math.erfc(abs(z) / math.sqrt(2))) < 1e-12
    assert 0.0 <= t["x"]["drift_score"] <= 1.0


def value(spark, fn, *numbers):
    """A Column function of numbers, as Spark computes it for a row."""
    row = spark.createDataFrame([tuple(float(x) for x in numbers)], [f"x{i}" for i in range(len(numbers))])
    return row.select(fn(*[F.col(c) for c in row.columns]).alias("v")).first()["v"]


def test_p_value_helpers(spark):
    assert abs(value(spark, stats.chi2_sf, 3.841458820694124, 1) - 0.05) < 1e-12
    assert abs(value(spark, stats.norm_two_sided_p, 1.959963984540054) - 0.05) < 1e-12
    assert abs(stats.ks_exact_p(0.5, 10, 10) - 0.16782134274394345) < 1e-9
    assert abs(value(spark, stats.kolmogorov_sf, 1.3580986393225505) - 0.05) < 1e-6
    assert value(spark, stats.kolmogorov_sf, 0.0) == 1.0 and value(spark, stats.chi2_sf, 0, 3) == 1.0
    assert value(spark, stats.chi2_sf, math.inf, 3) == 0.0 and math.isnan(value(spark, stats.chi2_sf, math.nan, 3))
    assert math.isnan(value(spark, stats.chi2_sf, 1.0, 0))


def test_tails_match_closed_forms(spark):
    # lgamma and erfc against the standard library, Q(k, x) against its Poisson sum
    points = [0.5, 1.0, 1.5, 2.0, 7.25, 50.0, 1234.5, 5e5]
    rows = spark.createDataFrame([(x,) for x in points], "x double")
    for r in rows.select("x", stats.lgamma(F.col("x")).alias("v")).collect():
        assert abs(r["v"] - math.lgamma(r["x"])) < 1e-12 * max(1.0, abs(r["v"]))
    zs = [0.0, 1e-3, 0.3, 1.0, 1.7, 2.5, 5.0, 9.0, 30.0]
    rows = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in rows.select("z", stats.norm_two_sided_p(F.col("z")).alias("v")).collect():
        want = math.erfc(r["z"] / math.sqrt(2))
        assert abs(r["v"] - want) <= 1e-12 * max(want, 1e-300) + 1e-15 * (r["z"] < 1.5)
    cases = [(k, x) for k in (1, 2, 5, 40, 300) for x in (0.1, 1.0, 4.9, 5.1, 39.0, 41.0, 250.0, 340.0)]
    rows = spark.createDataFrame([(float(k), x) for k, x in cases], "k double, x double")
    for r in rows.select("k", "x", stats.gamma_q(F.col("k"), F.col("x")).alias("v")).collect():
        want = math.fsum(math.exp(i * math.log(r["x"]) - r["x"] - math.lgamma(i + 1)) for i in range(int(r["k"])))
        assert abs(r["v"] - want) < 1e-11


def test_histograms_and_monitor(spark):
    df = spark.range(1500).select((F.col("id") % 10).cast("double").alias("x"), F.col("id").alias("k"))
    res = dr.monitor(df, df.where("k < 200"), key="k")
    h = res["histograms"].where("side = 'reference' AND column_name = 'x'").orderBy("bin").collect()
    assert len(h) == 10 and abs(sum(r["density"] * (r["bin_hi"] - r["bin_lo"]) for r in h) - 1.0) < 1e-9
    assert res["verdict"].first()["n_columns"] == 1


def test_stattest_override_and_results_independent_of_partitions(spark):
    a = spark.range(3000).select(((F.col("id") * 13) % 101).cast("double").alias("x"))
    b = spark.range(2500).select(((F.col("id") * 7) % 89).cast("double").alias("x"))
    s1 = _table(dr.drift_table(a.repartition(1), b.repartition(1), stattest="ks"))["x"]["drift_score"]
    s2 = _table(dr.drift_table(a.repartition(13), b.repartition(7), stattest="ks"))["x"]["drift_score"]
    assert s1 == s2


def test_few_valued_numbers_are_compared_by_value(spark):
    # 0 and 0.01 share any of 30 bins up to 100; the shift between them is strong
    ref = spark.createDataFrame([(v,) for v in [0.0] * 900 + [0.01] * 100 + [100.0] * 200], "x double")
    cur = spark.createDataFrame([(v,) for v in [0.0] * 100 + [0.01] * 900 + [100.0] * 200], "x double")
    row = dr.drift_table(ref, cur).first()
    assert row["stattest_name"] == "Jensen-Shannon distance" and row["drift_score"] > 0.3 and row["drift_detected"]


def test_tails_at_large_sizes(spark):
    chi = lambda x, k: value(spark, stats.chi2_sf, x, k)
    assert abs(chi(1e9, 1e9) - 0.5) < 1e-4 and abs(chi(1e8, 1e8) - 0.5) < 1e-4
    # both sides of the limit law agree
    assert abs(chi(1.001e6, 0.999e6) - chi(1.003001e6, 1.001e6)) < 2e-3
    limit = value(spark, stats.kolmogorov_sf, (1500 * 1400 / 2900) ** 0.5 * 0.05)
    assert abs(stats.ks_exact_p(0.05, 1500, 1400) - limit) < 0.01
    assert abs(stats.ks_exact_p(1.0, 3, 3) - 0.1) < 1e-12
