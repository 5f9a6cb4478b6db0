import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from riskframe.operators import augment as ag
from riskframe.plans import catalog
from riskframe.sources.transactions import transactions
from riskframe.streaming import jobs as st
from tests.conftest import SF_SMALL


def test_weighted_draw_follows_distribution_and_is_deterministic(spark):
    df = spark.range(20000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 < 7, "x").otherwise("y").alias("c"))
    dist = ag.distribution(df, "c")
    d1 = ag.weighted_draw(df.select("k"), dist, "k", 1, "c", "d")
    d2 = ag.weighted_draw(df.select("k").repartition(7), dist, "k", 1, "c", "d")
    share = d1.where("d = 'x'").count() / 20000
    assert abs(share - 0.7) < 0.02
    assert d1.count() == 20000
    assert sorted(map(tuple, d1.collect())) == sorted(map(tuple, d2.collect()))


def test_synthesize_modes(spark):
    tx = transactions(spark, SF_SMALL)
    real = ag.synthesize(tx, 50, 0.0)
    assert real.count() == 50 and real.columns == tx.columns
    like = ag.synthesize(tx, 50, 0.5, as_of=F.lit("2024-01-01").cast("timestamp"))
    rows = like.collect()
    assert len(rows) == 50 and like.columns == tx.columns
    cats = {r[0] for r in tx.select("category").distinct().collect()}
    assert all(r["category"] in cats and r["amt"] >= 0.01 for r in rows)
    rnd = ag.synthesize(tx, 40, 1.0).collect()
    assert all(1.0 <= r["amt"] <= 500.0 and 1000 <= r["city_pop"] <= 500000 for r in rnd)
    mix = ag.mix_real_synthetic(tx, 100)
    n_syn = mix.where("is_synthetic").count()
    assert mix.count() == 100 and 10 <= n_syn <= 90


def test_stream_features_equal_batch(spark):
    from riskframe.session import ensure_checkpoint_dir
    root = os.path.join(ensure_checkpoint_dir(spark), "test-stream")
    st.run_available_now(st.features_stream(spark, SF_SMALL), f"{root}/out", f"{root}/ckpt")
    streamed = spark.read.parquet(f"{root}/out")
    batch = catalog.feats(spark, SF_SMALL)
    assert streamed.count() == batch.count() == 1500
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0


def test_streams_read_tables_of_part_files(spark, scratch):
    import os
    for t in ("orders", "customer", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").repartition(3).write.parquet(f"{scratch}/{t}.parquet")
    from riskframe.streaming import jobs as st
    counts = []
    for n, d in enumerate((SF_SMALL, scratch)):
        out = os.path.join(scratch, f"out{n}")
        st.run_available_now(st.features_stream(spark, d), out, f"{out}-ckpt")
        counts.append(spark.read.parquet(out).count())
    assert counts == [1500, 1500]


def test_a_replayed_batch_replaces_its_rows(spark, scratch):
    from riskframe.streaming import jobs as st
    log = spark.createDataFrame([("a", 1)], "k string, n int")
    for _ in range(2):
        log.write.mode("overwrite").parquet(f"{scratch}/log/_batch=0")
    spark.createDataFrame([("a", 2)], "k string, n int").write.mode("overwrite").parquet(f"{scratch}/log/_batch=1")
    got = spark.read.parquet(f"{scratch}/log")
    assert got.count() == 2 and [tuple(r) for r in st.latest_state(got, ["k"]).collect()] == [("a", 2)]


def test_entry_and_registry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["category", "fraud_rate", "n"]
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 40


def test_draws_without_broadcast_match(spark):
    tx = transactions(spark, SF_SMALL)
    a = sorted(tuple(r) for r in ag.synthesize(tx, 60, 0.5, as_of=F.lit("2024-01-01").cast("timestamp")).collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted(tuple(r) for r in ag.synthesize(tx, 60, 0.5, as_of=F.lit("2024-01-01").cast("timestamp")).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert a == b
    assert ag.draw_buckets(10) == 1024 and ag.draw_buckets(1_000_000) == 1 << 22
