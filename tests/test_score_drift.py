"""Sketched score drift against exact quantiles and distribution functions."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import score_drift as sd
from riskframe.plans import jobs


def scores(spark, n=900, seed=2):
    rng = np.random.default_rng(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        day = int(rng.integers(0, 120))
        s = float(np.round(rng.beta(1, 6) + (0.25 if day >= 91 else 0.0), 3))  # moves up in April
        rows.append((start + dt.timedelta(days=day, hours=int(rng.integers(0, 24))), s, int(rng.random() < s)))
    rows += [(None, 0.5, 1), (start, None, 1), (start, 0.125, None)]
    return rows, spark.createDataFrame(rows, "ts timestamp, s double, y int")


def by_hand(rows):
    out = {}
    for t, s, y in rows:
        if t is not None and s is not None:
            out.setdefault(t.date().replace(day=1), []).append((s, y))
    months = sorted(out)
    ref = sorted(s for s, _ in out[months[0]])
    grid = [ref[math.ceil(q * len(ref)) - 1] for q in sd.GRID]
    cdf = lambda v, x: sum(a <= x for a in v) / len(v)
    res = {}
    for m in months:
        v = sorted(s for s, _ in out[m])
        res[m] = (len(v), sum(y == 1 for _, y in out[m]), [v[math.ceil(q * len(v)) - 1] for q in sd.QUANTILES],
                  max(abs(cdf(v, x) - cdf(ref, x)) for x in grid))
    return res


def check(found, want):
    got = {r["window"]: r for r in found.collect()}
    assert set(got) == set(want)
    for m, (n, pos, qs, gap) in want.items():
        r = got[m]
        assert (r["n_rows"], r["n_pos"]) == (n, pos) and [r["p25"], r["p50"], r["p75"], r["p95"]] == qs
        assert abs(r["distance"] - gap) < 1e-12 and r["drift"] == (gap >= 0.1)


def test_windows_equal_exact_statistics_and_merge_in_any_order(spark):
    rows, df = scores(spark)
    want = by_hand(rows)
    days = sd.daily_scores(df.repartition(7), "ts", "s", "y")
    check(sd.score_drift(sd.merged(days)), want)
    assert max(w[3] for w in want.values()) > 0.3  # April
    years = sd.merged(sd.merged(days, "month"), "year").first()
    assert years["n_rows"] == sum(w[0] for w in want.values())


def test_reference_window_and_empty(spark):
    _, df = scores(spark)
    months = sd.merged(sd.daily_scores(df, "ts", "s", "y"))
    april = {r["window"].month: r["distance"] for r in sd.score_drift(months, "2024-04-01").collect()}
    assert april[4] == 0 and april[1] > 0.3
    with pytest.raises(ValueError):
        sd.score_drift(months, "2020-01-01")
    assert sd.score_drift(sd.merged(sd.daily_scores(df.where("false"), "ts", "s", "y"))).collect() == []


def test_large_windows_stay_near(spark):
    df = spark.range(60000).select(F.lit("2024-01-05").cast("timestamp").alias("ts"), (F.rand(1) * F.rand(2)).alias("s"), F.lit(0).alias("y"))
    df = df.checkpoint()
    row = sd.score_drift(sd.merged(sd.daily_scores(df, "ts", "s", "y"))).first()
    for q in sd.QUANTILES:
        assert abs(df.where(F.col("s") <= row[f"p{round(100 * q)}"]).count() / 60000 - q) < 0.002


def test_days_stored_again_replace_themselves(spark, scratch):
    rows, df = scores(spark)
    how = {"ts": "ts", "score": "s", "label": "y"}
    jobs.track_scores(spark, scratch, df.where("ts < '2024-02-01'"), **how)
    jobs.track_scores(spark, scratch, df.where("ts >= '2024-02-01'"), **how)
    check(jobs.track_scores(spark, scratch, df.where("ts >= '2024-03-01'"), **how), by_hand(rows))
