import random

import pandas as pd
from pyspark.sql import functions as F

from riskframe.functions.prefix import running_totals
from riskframe.operators import sampling as sm


def _naive_running(pdf, group, order, col):
    pdf = pdf.sort_values([group, order])
    pdf["exp"] = pdf.groupby(group)[col].cumsum()
    pdf["nxt"] = pdf.groupby(group)[order].shift(-1)
    return pdf


def test_running_totals_matches_naive_window(spark):
    rnd = random.Random(7)
    rows = []
    for g in range(3):
        vals = sorted({round(rnd.uniform(-50, 50), 3) for _ in range(400 * (g + 1))})
        rows += [(g, v, rnd.randint(1, 9)) for v in vals]
    df = spark.createDataFrame(rows, "g int, v double, c long").repartition(5)
    for parts in (1, 3, 40):
        got = running_totals(df, ["g"], "v", ["c"], partitions=parts, next_col="nxt").toPandas()
        exp = _naive_running(pd.DataFrame(rows, columns=["g", "v", "c"]), "g", "v", "c")
        m = got.merge(exp, on=["g", "v"])
        assert len(m) == len(rows)
        assert (m["cum_c"] == m["exp"]).all()
        assert ((m["nxt_x"] == m["nxt_y"]) | (m["nxt_x"].isna() & m["nxt_y"].isna())).all()


def test_text_with_a_common_prefix_spreads_over_ranges(spark):
    from riskframe.functions.ordered import PART, range_split
    df = spark.range(2000).select(F.lit("g").alias("g"), F.format_string("merchant_%05d", "id").alias("v"), F.lit(1).alias("c"))
    sizes = [r["count"] for r in range_split(df, ["g", "v"], 8).groupBy(PART).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 500
    got = running_totals(df, ["g"], "v", ["c"], partitions=8, next_col="n").orderBy("v").collect()
    assert [r["cum_c"] for r in got] == list(range(1, 2001))
    assert [r["n"] for r in got] == [f"merchant_{i:05d}" for i in range(1, 2000)] + [None]


def test_running_totals_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "g int, v double, c long")
    assert running_totals(empty, ["g"], "v", ["c"], next_col="n").collect() == []
    rows = [(None, None, 1), (None, 2.0, 2), (1, None, 4), (1, 3.0, 8)]
    got = running_totals(spark.createDataFrame(rows, "g int, v double, c long"), ["g"], "v", ["c"], next_col="n").collect()
    assert sorted((r["cum_c"], r["n"]) for r in got if r["v"] is not None) == [(3, None), (12, None)]
    assert sorted((r["cum_c"], r["n"]) for r in got if r["v"] is None) == [(1, 2.0), (4, 3.0)]


def test_running_totals_text_order_and_no_group(spark):
    words = sorted({"".join(random.Random(i).choices("abcxyz", k=5)) for i in range(300)})
    df = spark.createDataFrame([(w, 1) for w in words], "w string, c long")
    got = running_totals(df, [], "w", ["c"], partitions=16).orderBy("w").collect()
    assert [r["cum_c"] for r in got] == list(range(1, len(words) + 1))


def test_approximate_mode_sklearn_allocation():
    # 80/20 split of 4 rows, 2 per class: one test row per class
    assert sm.split_quotas({0: 2, 1: 2}, test_size=0.5) == {0: 1, 1: 1}
    q = sm.split_quotas({0: 14496, 1: 504}, test_size=0.2)
    assert sum(q.values()) == 3000 and q == {0: 2899, 1: 101}
    # the stored run: ceil(0.2 * 555719) = 111144 test rows
    assert sum(sm.split_quotas({0: 553574, 1: 2145}, test_size=0.2).values()) == 111144


def test_mark_by_hash_rank_matches_brute_force(spark):
    rows = [(i, i % 3 if i % 10 else 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, g int")
    quota = {0: 300, 1: 0, 2: 10_000}
    got = {r["k"] for r in sm.mark_by_hash_rank(df, "k", 42, quota, by="g").where("_selected").collect()}
    import hashlib
    pdf = pd.DataFrame(rows, columns=["k", "g"])
    pdf["h"] = [hashlib.md5(f"{k}-42".encode()).hexdigest() for k in pdf.k]
    pdf = pdf.sort_values(["g", "h", "k"])
    pdf["r"] = pdf.groupby("g").cumcount()
    exp = set(pdf[pdf.r < pdf.g.map(quota)].k)
    assert got == exp
    # a stratum missing from the quotas selects nothing
    part = {r["k"] for r in sm.mark_by_hash_rank(df, "k", 42, {0: 5}, by="g").where("_selected").collect()}
    assert part == set(pdf[(pdf.g == 0) & (pdf.r < 5)].k)


def test_split_is_exact_disjoint_and_partition_independent(spark):
    rows = [(i, 1 if i % 37 == 0 else 0) for i in range(5000)]
    df = spark.createDataFrame(rows, "trans_num long, is_fraud int")
    a = sm.stratified_split(df.repartition(1), "trans_num")
    b = sm.stratified_split(df.repartition(16), "trans_num")
    ta = {r[0] for r in a.where("split = 'test'").select("trans_num").collect()}
    tb = {r[0] for r in b.where("split = 'test'").select("trans_num").collect()}
    assert ta == tb
    assert a.count() == 5000
    counts = {r["is_fraud"]: r["count"] for r in a.where("split = 'test'").groupBy("is_fraud").count().collect()}
    assert counts == sm.split_quotas({0: 5000 - 136, 1: 136}, test_size=0.2)
    # class rate preserved within 0.1 (the reference's property)
    rate = a.groupBy("split").agg(F.avg("is_fraud").alias("r")).collect()
    assert all(abs(r["r"] - 136 / 5000) < 0.1 for r in rate)


def test_split_guard(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "trans_num long, is_fraud int")
    try:
        sm.stratified_split(df, "trans_num")
        raise AssertionError("expected the class guard")
    except ValueError:
        pass


def test_rare_class_branch_keeps_all_positives(spark):
    rows = [(i, 1 if i in (5, 77, 300) else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "trans_num long, is_fraud int")
    out = sm.rare_class_sample(df, "trans_num")
    assert out.count() == int(0.95 * 1000)
    assert out.where("is_fraud = 1").count() == 3


def test_sample_n_and_balance(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    s = sm.sample_n(df, 123, "k")
    assert s.count() == 123 and s.distinct().count() == 123
    assert sm.sample_n(df, 10**6, "k").count() == 3000
    cur = spark.range(0, 100).withColumnRenamed("id", "k")
    assert sm.balanced_reference(df, cur, "k").count() == 500


def test_sampling_tables_of_copies(spark):
    # 3000 rows: a third are copies of one row, the rest two more copy groups; no key column
    df = spark.range(3000).select((F.col("id") % 3).alias("v"), F.lit("x").alias("t"))
    s = sm.sample_n(df, 1000, None)
    assert s.count() == 1000 and s.columns == ["v", "t"]
    comp = spark.range(3000).select((F.col("id") % 3).alias("a"), (F.col("id") / 3).cast("long").alias("b"))
    assert sm.sample_n(comp, 777, ["a", "b"]).count() == 777
