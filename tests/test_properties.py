"""Property tests (hypothesis) for the two scale primitives."""

import hashlib

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskframe.functions.prefix import running_totals
from riskframe.operators import sampling as sm

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(-1000, 1000), st.integers(1, 5)), min_size=1, max_size=300),
       parts=st.integers(1, 20))
def test_running_totals_equal_naive(spark, rows, parts):
    pdf = pd.DataFrame(rows, columns=["g", "v", "c"]).drop_duplicates(["g", "v"])
    got = running_totals(spark.createDataFrame(pdf), ["g"], "v", ["c"], partitions=parts).toPandas()
    exp = pdf.sort_values(["g", "v"]).assign(exp=lambda d: d.groupby("g")["c"].cumsum())
    m = got.merge(exp, on=["g", "v"])
    assert len(m) == len(pdf) and (m["cum_c"] == m["exp"]).all()


@SETTINGS
@given(n=st.integers(1, 400), strata=st.integers(1, 4), quota=st.integers(0, 150), seed=st.integers(0, 99))
def test_hash_rank_selection_equals_brute_force(spark, n, strata, quota, seed):
    rows = [(i, i % strata) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, g int")
    q = {g: quota + g for g in range(strata)}
    got = {r["k"] for r in sm.mark_by_hash_rank(df, "k", seed, q, by="g").where("_selected").collect()}
    pdf = pd.DataFrame(rows, columns=["k", "g"])
    pdf["h"] = [hashlib.md5(f"{k}-{seed}".encode()).hexdigest() for k in pdf.k]
    pdf = pdf.sort_values(["g", "h", "k"])
    pdf["r"] = pdf.groupby("g").cumcount()
    assert got == set(pdf[pdf.r < pdf.g.map(q)].k)
