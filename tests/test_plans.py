"""Physical-plan properties the operators rely on for scale."""

from functools import partial

from pyspark.sql import functions as F

from riskframe.operators import features as fe
from riskframe.operators import profile as pr
from riskframe.operators import sampling as sm
from riskframe.plans import catalog
from riskframe.sources.transactions import transactions
from tests.conftest import SF_SMALL


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_filters_pushed(spark):
    tx = fe.where_amount_below(transactions(spark, SF_SMALL), 1000.0)
    plan = _physical(fe.build_features(tx).select("trans_num", "amt", "category"))
    orders_scan = [ln for ln in plan.split("\n") if "orders.parquet" in ln or "o_orderkey" in ln and "ReadSchema" in ln]
    assert any("o_totalprice" in ln for ln in orders_scan)
    assert "o_orderstatus" not in plan  # never read
    assert "LessThan(o_totalprice,1000.0)" in plan.replace(" ", "")
    assert "BroadcastHashJoin" in plan


def test_preview_hands_on_k_values_a_task(spark):
    rows = spark.range(20000, numPartitions=4).select(F.concat(F.lit("v"), F.col("id") % 5000).alias("a"), F.lit("hot").alias("b"),
                                                      F.lit(None).cast("string").alias("c"))
    parts = rows.mapInArrow(partial(pr._least_distinct, 5), "column_name string, value string").groupBy(
        F.spark_partition_id().alias("p"), "column_name").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) == 5
    got = [tuple(r) for r in pr.value_preview(rows).orderBy("column_name", "pos").collect()]
    assert got == [("a", i, v) for i, v in enumerate(sorted(f"v{i}" for i in range(5000))[:5], 1)] + [("b", 1, "hot")]
    plan = _physical(pr.value_preview(rows))
    assert plan.index("MapInArrow") > plan.index("Exchange")  # printed from the top: the limit comes before the exchange


def test_split_reads_the_input_once_and_shuffles_nothing(spark):
    plan = _physical(sm.stratified_split(catalog.feats(spark, SF_SMALL), "trans_num"))
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "Union" not in plan
    assert plan.count("orders.parquet") == 1


def test_sample_is_one_pass_and_equals_the_hash_ranks(spark):
    f = catalog.feats(spark, SF_SMALL).select("trans_num", "is_fraud")
    plan = _physical(sm.sample_n(f, 100, "trans_num"))
    assert plan.count("orders.parquet") == 1 and "WindowGroupLimit" in plan and "TakeOrderedAndProject" in plan
    ranks = sm.mark_by_hash_rank(f, "trans_num", 42, 100).where("_selected").drop("_selected")
    assert sorted(sm.sample_n(f.repartition(13), 100, "trans_num").collect()) == sorted(ranks.collect())


def test_distinct_counts_near_the_limit_are_exact_without_an_expand(spark):
    cols = {f"c{n}": (F.col("id") % n).cast("string") for n in (1, 3, 95, 99, 100, 101, 104, 130, 5000)}
    rows = spark.range(6000).select(*[c.alias(k) for k, c in cols.items()], F.lit(None).cast("string").alias("none"))
    got = {r["column_name"]: r for r in pr.high_cardinality(rows).collect()}
    assert {k for k, r in got.items() if r["high_cardinality"]} == {"c101", "c104", "c130", "c5000"}
    for k in ("c95", "c99", "c100", "c101", "c104"):
        assert got[k]["exact"] and got[k]["n_distinct"] == int(k[1:])
    assert not got["c5000"]["exact"] and got["none"]["n_distinct"] == 0


def test_encoder_joins_are_broadcast(spark):
    from riskframe.operators import encode as en
    f = catalog.feats(spark, SF_SMALL)
    enc = en.fit_target_encoder(f)
    plan = _physical(en.apply_target_encoder(f, enc))
    assert plan.count("BroadcastHashJoin") >= 5 and "SortMergeJoin" not in plan


def test_large_encoder_tables_fall_back_to_shuffle_joins(spark):
    from riskframe.operators import encode as en
    f = catalog.feats(spark, SF_SMALL)
    enc = en.fit_target_encoder(f)
    small = sorted(tuple(r) for r in en.apply_target_encoder(f, enc).select("trans_num", "merchant", "state").collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = en.apply_target_encoder(f, enc)
        plan = _physical(out)
        big = sorted(tuple(r) for r in out.select("trans_num", "merchant", "state").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert small == big
