"""One key holding a third of all rows: results stay exact and the heavy
steps aggregate before they shuffle."""

import pandas as pd
from pyspark.sql import functions as F

from riskframe.operators import drift as dr
from riskframe.operators import encode as en
from riskframe.operators import sampling as sm
from riskframe.operators.features import build_features
from riskframe.sources.transactions import transactions
from tests.conftest import SF_MID


def _hot(spark):
    f = build_features(transactions(spark, SF_MID))
    # a third of the rows share one merchant and one state
    hot = (F.col("trans_num") % 3) == 0
    return f.withColumn("merchant", F.when(hot, "merchant_hot").otherwise(F.col("merchant"))).withColumn(
        "state", F.when(hot, "HOT").otherwise(F.col("state")))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_encoder_on_hot_key_is_exact_and_partially_aggregated(spark):
    f = _hot(spark)
    enc = en.fit_target_encoder(f, ["merchant"], materialize=False)
    assert "partial_count" in _plan(enc) or "partial_" in _plan(enc)
    got = {r["value"]: (r["n"], r["mean"]) for r in enc.collect()}
    pdf = f.select("merchant", "is_fraud").toPandas()
    exp = pdf.groupby("merchant")["is_fraud"].agg(["count", "mean"])
    assert got["merchant_hot"][0] == exp.loc["merchant_hot", "count"] == 5000
    for k, row in exp.iterrows():
        assert got[k][0] == row["count"] and abs(got[k][1] - row["mean"]) < 1e-12


def test_split_and_drift_on_hot_key(spark):
    f = _hot(spark).checkpoint(eager=True)
    s = sm.stratified_split(f, "trans_num")
    counts = {(r["split"], r["is_fraud"]): r["count"] for r in s.groupBy("split", "is_fraud").count().collect()}
    assert counts[("test", 0)] + counts[("test", 1)] == 3000
    ref, cur = f.where("trans_num % 2 = 0"), f.where("trans_num % 2 = 1")
    vc = dr.value_counts(ref, cur, ["merchant", "state", "amt"])
    hot = vc.where("cat = 'merchant_hot'").first()
    assert hot["n_ref"] + hot["n_cur"] == 5000
    t = {r["column_name"]: r for r in dr.drift_table(ref, cur, ["merchant", "state", "amt"], vc=vc).collect()}
    assert t["merchant"]["stattest_name"] == "Jensen-Shannon distance"
    pr = ref.select("merchant").toPandas()["merchant"].value_counts(normalize=True)
    pc = cur.select("merchant").toPandas()["merchant"].value_counts(normalize=True)
    keys = sorted(set(pr.index) | set(pc.index))
    import math
    p = pd.Series([pr.get(k, 0.0) for k in keys])
    q = pd.Series([pc.get(k, 0.0) for k in keys])
    m = (p + q) / 2
    kl = lambda a: sum(x * math.log(x / y) for x, y in zip(a, m) if x > 0)
    assert abs(t["merchant"]["drift_score"] - math.sqrt((kl(p) + kl(q)) / 2)) < 1e-12
