"""Raw card-transaction table (22 columns) derived from the driver tables.

The driver data has no card table, so a transaction is an order joined with
its customer and the customer's nation.  Every derived value is a plain
column expression, so the whole view is one scan of ``orders`` plus two
dimension joins.  ``nation`` is the fixed 25-row table and is broadcast
explicitly.  ``customer`` is a plain parquet scan whose size Catalyst knows
from file statistics: it is broadcast while under
``spark.sql.autoBroadcastJoinThreshold`` and sort-merge joined beyond it
(bucket both tables by customer key to make that join shuffle-free).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.tables import read_table

# Raw transaction columns in the order of the fixed transaction schema.
RAW_COLUMNS = [
    "trans_date_trans_time", "cc_num", "merchant", "category", "amt", "first", "last", "gender",
    "street", "city", "state", "zip", "lat", "long", "city_pop", "job", "dob", "trans_num",
    "unix_time", "merch_lat", "merch_long", "is_fraud",
]


def _s(c: Column) -> Column:
    return c.cast("string")


def _d(c: Column) -> Column:
    return c.cast("double")


def derive_transactions(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Map ``orders ⋈ customer ⋈ nation`` rows to raw transactions."""
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    # customer: Catalyst's statistics-based size check picks broadcast or sort-merge
    # nation is the fixed 25-row dimension: a proven size bound
    j = (o.join(c, o["o_custkey"] == c["c_custkey"])
          .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")))
    ok, ck = F.col("o_orderkey"), F.col("c_custkey")
    hours = ((ok * 7) % 24).cast("int")
    ts = F.timestamp_add("HOUR", hours, F.col("o_orderdate").cast("timestamp"))
    lat = F.lit(25.0) + _d(ck % 2000) / F.lit(100.0)
    lon = F.lit(-120.0) + _d(ck % 4500) / F.lit(100.0)
    label = (F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000)
                    & (ok % 4 != 0), 1)
              .when(ok % 400 == 0, 1).otherwise(0).cast("int"))
    return j.select(
        ts.alias("trans_date_trans_time"),
        F.col("o_custkey").alias("cc_num"),
        F.concat(F.lit("merchant_"), _s(ok % 50)).alias("merchant"),
        F.col("o_orderpriority").alias("category"),
        _d(F.col("o_totalprice")).alias("amt"),
        F.concat(F.lit("first_"), _s(ck % 31)).alias("first"),
        F.col("c_name").alias("last"),
        F.when(ck % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(_s(ck), F.lit(" Main St")).alias("street"),
        F.concat(F.lit("city_"), _s(ck % 40)).alias("city"),
        F.col("n_name").alias("state"),
        (F.lit(10000) + ck % 89999).cast("int").alias("zip"),
        lat.alias("lat"),
        lon.alias("long"),
        (F.lit(1000) + (ck * 37) % 500000).cast("long").alias("city_pop"),
        F.col("c_mktsegment").alias("job"),
        F.make_date((F.lit(1940) + ck % 60).cast("int"), F.lit(1), F.lit(15)).alias("dob"),
        ok.alias("trans_num"),
        F.unix_timestamp(ts).alias("unix_time"),
        (lat + _d((ok % 200) - 100) / F.lit(100.0)).alias("merch_lat"),
        (lon + _d((ok % 180) - 90) / F.lit(100.0)).alias("merch_long"),
        label.alias("is_fraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions for one scale-factor folder."""
    return derive_transactions(read_table(spark, sf_dir, "orders"),
                               read_table(spark, sf_dir, "customer"),
                               read_table(spark, sf_dir, "nation"))


# DuckDB text of the same view, used by the oracle queries.
TRANSACTIONS_SQL = """
SELECT o_orderdate + to_hours(CAST((o_orderkey * 7) % 24 AS INTEGER)) AS trans_date_trans_time,
  o_custkey AS cc_num,
  concat('merchant_', CAST(o_orderkey % 50 AS VARCHAR)) AS merchant,
  o_orderpriority AS category,
  CAST(o_totalprice AS DOUBLE) AS amt,
  concat('first_', CAST(c_custkey % 31 AS VARCHAR)) AS first,
  c_name AS last,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  concat(CAST(c_custkey AS VARCHAR), ' Main St') AS street,
  concat('city_', CAST(c_custkey % 40 AS VARCHAR)) AS city,
  n_name AS state,
  CAST(10000 + c_custkey % 89999 AS INTEGER) AS zip,
  CAST(25.0 AS DOUBLE) + CAST(c_custkey % 2000 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS lat,
  CAST(-120.0 AS DOUBLE) + CAST(c_custkey % 4500 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS long,
  CAST(1000 + (c_custkey * 37) % 500000 AS BIGINT) AS city_pop,
  c_mktsegment AS job,
  make_date(CAST(1940 + c_custkey % 60 AS INTEGER), 1, 15) AS dob,
  o_orderkey AS trans_num,
  CAST(epoch(o_orderdate + to_hours(CAST((o_orderkey * 7) % 24 AS INTEGER))) AS BIGINT) AS unix_time,
  CAST(25.0 AS DOUBLE) + CAST(c_custkey % 2000 AS DOUBLE) / CAST(100.0 AS DOUBLE)
    + CAST((o_orderkey % 200) - 100 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS merch_lat,
  CAST(-120.0 AS DOUBLE) + CAST(c_custkey % 4500 AS DOUBLE) / CAST(100.0 AS DOUBLE)
    + CAST((o_orderkey % 180) - 90 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS merch_long,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 AND o_orderkey % 4 <> 0 THEN 1
       WHEN o_orderkey % 400 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""
