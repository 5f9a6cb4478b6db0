"""Table augmentation: realistic rows from a real table.

Every random draw is a hash of (row key, seed, field), so results are
reproducible and independent of partitioning.  A categorical draw from a
weighted distribution is a range lookup ``lo <= u < hi`` done as a bucketed
equi-join: the distribution is exploded over the equal-width buckets it
overlaps (at most values + buckets rows, with at least 4 buckets per value),
rows join on their bucket, and the range predicate finishes the match — no
nested-loop join, no collect.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import col_, hash_unit
from riskframe.functions.joins import sized_broadcast
from riskframe.functions.prefix import running_totals
from riskframe.operators.sampling import sample_n
from riskframe.session import ensure_checkpoint_dir

DRAW_BUCKETS = 1024
# Jitter scales per unit of variability and fully random ranges.
LATLON_SIGMA = 0.001
AMOUNT_SIGMA = 10.0
AMOUNT_FLOOR = 0.01
CITY_POP_SIGMA = 1000.0
MERCHANT_OFFSET = 0.001
RANDOM_AMOUNT = (1.0, 500.0)
RANDOM_CITY_POP = (1000, 500000)
CATEGORICAL_FIELDS = ["category", "gender", "state", "job"]


def distributions(df: DataFrame, fields: list[str], weighted: bool | dict = True) -> DataFrame:
    """``(field, value, n, lo, hi)`` for several columns in one aggregation:
    each non-null value's share as a sub-interval of [0, 1), in value order
    (values as text).  ``weighted=False`` (or per field in a dict) gives
    every value equal share: a uniform draw from the value pool."""
    long = df.select(*[F.col(f).cast("string").alias(f) for f in fields]).unpivot(
        [], fields, "field", "value").where(F.col("value").isNotNull())
    vc = long.groupBy("field", "value").agg(F.count("*").alias("n"))
    wmap = weighted if isinstance(weighted, dict) else {f: weighted for f in fields}
    uniform = [f for f in fields if not wmap.get(f, True)]
    if uniform:
        vc = vc.withColumn("n", F.when(F.col("field").isin(*uniform), F.lit(1)).otherwise(F.col("n")).cast("long"))
    ensure_checkpoint_dir(df.sparkSession)
    vc = vc.checkpoint(eager=True)  # read by the running counts and the field totals
    rt = running_totals(vc, ["field"], "value", ["n"])
    totals = vc.groupBy("field").agg(F.sum("n").alias("_tot"))
    # one row per field
    rt = rt.join(F.broadcast(totals), "field")
    return rt.select("field", "value", "n", ((F.col("cum_n") - F.col("n")) / F.col("_tot")).alias("lo"),
                     (F.col("cum_n") / F.col("_tot")).alias("hi"))


def distribution(df: DataFrame, col: str, weighted: bool = True) -> DataFrame:
    """``(value, n, lo, hi)`` of one column (see ``distributions``)."""
    return distributions(df, [col], weighted).drop("field")


def unit_draw(key, seed, field: str) -> Column:
    return hash_unit(key, f"{seed}-{field}")


def gaussian_draw(key, seed, field: str) -> Column:
    """Standard normal from two hash uniforms (Box-Muller)."""
    u1 = unit_draw(key, seed, field + "-a")
    u2 = unit_draw(key, seed, field + "-b")
    u1 = F.greatest(u1, F.lit(1e-300))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def draw_buckets(n_values: int) -> int:
    """Buckets for the range lookup: at least 1024 and 4 per value (a power of
    two), so a distribution too big to broadcast still spreads a shuffle join
    over many keys."""
    return max(DRAW_BUCKETS, 1 << max(0, (4 * max(n_values, 1) - 1).bit_length()))


def weighted_draw(df: DataFrame, dist: DataFrame, key: str, seed, field: str, out: str,
                  n_values: int | None = None) -> DataFrame:
    """Add ``out``: the value whose [lo, hi) holds the row's hash uniform."""
    b = draw_buckets(n_values if n_values is not None else dist.count())
    d = dist.select(F.col("value").alias(f"_val_{out}"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                    F.explode(F.sequence(F.floor(F.col("lo") * b).cast("int"),
                                         F.least(F.ceil(F.col("hi") * b).cast("int") - 1, F.lit(b - 1))))
                    .alias("_db"))
    u = unit_draw(key, seed, field)
    rows = df.withColumn("_u", u).withColumn("_db", F.floor(F.col("_u") * b).cast("int"))
    # the size that counts is that of the values spread over their buckets
    j = rows.join(sized_broadcast(d), "_db").where((F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi")))
    return j.drop("_db", "_lo", "_hi", "_u").withColumnRenamed(f"_val_{out}", out)


def jitter(df: DataFrame, variability: float, key: str = "trans_num", seed=42) -> DataFrame:
    """Perturb coordinates, amount and population; merchant point within
    +/- 0.001 of the (new) home point."""
    v = float(variability)
    g = lambda f: gaussian_draw(key, seed, f)
    lat = F.col("lat") + g("lat") * F.lit(v * LATLON_SIGMA)
    lon = F.col("long") + g("long") * F.lit(v * LATLON_SIGMA)
    amt = F.round(F.greatest(F.lit(AMOUNT_FLOOR), F.col("amt") + g("amt") * F.lit(v * AMOUNT_SIGMA)), 2)
    pop = (F.col("city_pop") + g("city_pop") * F.lit(v * CITY_POP_SIGMA)).cast("long")
    off = lambda f: (unit_draw(key, seed, f) * 2 - 1) * F.lit(MERCHANT_OFFSET)
    out = df.withColumns({"lat": lat, "long": lon, "amt": amt, "city_pop": pop})
    return out.withColumns({"merch_lat": F.col("lat") + off("merch_lat"),
                            "merch_long": F.col("long") + off("merch_long")})


def new_trans_num(key, seed) -> Column:
    return F.md5(F.concat(col_(key).cast("string"), F.lit(f"-{seed}-synthetic")))


def synthesize(df: DataFrame, n: int, variability: float, key: str = "trans_num", seed=42,
               as_of: Column | None = None) -> DataFrame:
    """``n`` rows shaped like ``df``.

    variability <= 0: real rows (seeded sample).  >= 1: every field drawn at
    random (uniform over value pools and ranges; identity fields stay those
    of a sampled row).  In between: a sampled row with jittered numbers and
    categorical fields redrawn from their observed distributions.
    """
    base = sample_n(df, n, key, seed)
    if variability <= 0:
        return base
    as_of = as_of if as_of is not None else F.current_timestamp()
    full = variability >= 1
    fields = CATEGORICAL_FIELDS + ["merchant", "is_fraud"] + (["city"] if full else [])
    weights = {f: (not full) for f in CATEGORICAL_FIELDS}
    weights.update({"merchant": False, "is_fraud": True, "city": False})
    # all value distributions in one aggregation, materialised once
    dists = distributions(df, fields, weights).checkpoint(eager=True)
    # one row per field
    sizes = {r["field"]: r["k"] for r in dists.groupBy("field").agg(F.count("*").alias("k")).collect()}
    out = base
    types = dict(df.dtypes)
    for f in fields:
        out = weighted_draw(out.drop(f), dists.where(F.col("field") == f).drop("field"), key, seed, f, f,
                            n_values=sizes.get(f, 0)).withColumn(f, F.col(f).cast(types[f]))
    if full:
        u = lambda f: unit_draw(key, seed, f)
        lo, hi = RANDOM_AMOUNT
        plo, phi = RANDOM_CITY_POP
        out = out.withColumns({
            "amt": F.round(F.lit(lo) + u("amt") * F.lit(hi - lo), 2),
            "city_pop": (F.lit(plo) + F.floor(u("city_pop") * F.lit(phi - plo + 1))).cast("long"),
            "lat": u("lat") * 180 - 90, "long": u("long") * 360 - 180,
            "merch_lat": u("merch_lat") * 180 - 90, "merch_long": u("merch_long") * 360 - 180})
    else:
        out = jitter(out, variability, key, seed)
    out = out.withColumns({"trans_date_trans_time": as_of, "unix_time": F.unix_timestamp(as_of)})
    out = out.withColumn(key, new_trans_num(key, seed))
    return out.select(*df.columns)


def mix_real_synthetic(df: DataFrame, n: int, key: str = "trans_num", seed=42, variability: float = 1.0,
                       ratio: float | None = None) -> DataFrame:
    """``n`` rows: a real share (ratio drawn in [0.1, 0.9] from the seed unless
    given) plus synthetic rows, flagged by ``is_synthetic``."""
    if ratio is None:
        import hashlib
        h = int(hashlib.md5(f"{seed}-ratio".encode()).hexdigest()[:13], 16) / 16 ** 13
        ratio = round(0.1 + 0.8 * h, 2)
    n_real = int(n * ratio)
    real = sample_n(df, n_real, key, seed).withColumn(key, F.col(key).cast("string"))
    fake = synthesize(df, n - n_real, variability, key, f"{seed}-fake")
    return (real.withColumn("is_synthetic", F.lit(False))
            .unionByName(fake.withColumn(key, F.col(key).cast("string")).withColumn("is_synthetic", F.lit(True))))


__all__ = ["distributions", "distribution", "weighted_draw", "jitter", "synthesize", "mix_real_synthetic"]
