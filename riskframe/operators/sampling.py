"""Reproducible sampling and stratified splits.

Order key: ``md5(key || '-' || seed)`` then ``key`` (keys must be unique).
A row is selected when its rank inside its stratum is below the stratum's
quota.  Ranks are never computed with one window over a whole stratum (the
negative class holds ~99.6 % of rows); instead:

1. the top 20 bits of the hash put every row in one of 2**20 ordered buckets;
2. ``count`` per (stratum, bucket) and a window over those small counts find,
   per stratum, the bucket holding the quota-th row (the boundary);
3. the boundary bucket (~n / 2**20 rows) is ranked to find the stratum's last
   selected (hash, key); the result is one comparison with it per row, without
   a join, union or window over the input.

Exact quotas, no driver collection of rows, no dependence on partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import rank_hash
from riskframe.functions.joins import sized_broadcast
from riskframe.session import ensure_checkpoint_dir

HASH_BUCKET_HEX = 5  # 20 bits
BOTTOM_K = 50_000  # rows that one task may gather of a sample, from each group
MERGE_GROUPS = 64


def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Largest-remainder allocation of ``n_draws`` over class counts.

    Deterministic: equal remainders go to the smaller class value first.
    """
    total = sum(counts.values())
    keys = sorted(counts)
    cont = {k: float(counts[k]) * n_draws / total for k in keys}
    alloc = {k: math.floor(cont[k]) for k in keys}
    need = n_draws - sum(alloc.values())
    order = sorted(keys, key=lambda k: (-(cont[k] - alloc[k]), k))
    for k in order[:need]:
        alloc[k] += 1
    return alloc


def class_sizes(df: DataFrame, label: str) -> dict:
    """Class -> count (one row per class reaches the driver)."""
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def check_classes(counts: dict, min_per_class: int = 2) -> None:
    """Guard before a stratified split: >= 2 classes, each with >= 2 rows."""
    if len(counts) < 2 or any(v < min_per_class for v in counts.values()):
        raise ValueError(f"Not enough examples in each class for stratified split: {counts}")


def with_row_key(df: DataFrame, name: str = "_rowid") -> DataFrame:
    """A unique id per row for tables without a key (copies of a row included):
    assigned once on a checkpointed copy, so every later read sees the same ids."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.withColumn(name, F.monotonically_increasing_id()).checkpoint(eager=True)


def mark_by_hash_rank(df: DataFrame, key, seed: int, quota, by: str | None = None,
                      flag: str = "_selected") -> DataFrame:
    """Add boolean ``flag``: rank of (md5(key-seed), key) within ``by`` < quota.

    ``quota`` is an int (no strata), a dict stratum -> int, or a callable
    mapping the stratum sizes (dict) to such a dict; the sizes come from the
    bucket counts, so no extra pass over ``df`` is needed for them.

    ``key`` must identify rows: a column, a list of columns, or None (a row
    id is assigned).  With a unique key every hash bucket holds ~n / 2**20
    rows, so even a table made of many copies of one row never puts them all
    in the one bucket that is ranked.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if key is None:
        df = with_row_key(df)
        key = "_rowid"
    order_keys = list(key) if isinstance(key, (list, tuple)) else [key]
    g = by or "_stratum"
    d = df if by else df.withColumn(g, F.lit(0))
    d = d.withColumn("_h", rank_hash(key, seed))
    d = d.withColumn("_hb", F.conv(F.substring("_h", 1, HASH_BUCKET_HEX), 16, 10).cast("int"))
    # at most strata x 2**20 rows, whatever the input size
    cnt = d.groupBy(g, "_hb").count().checkpoint(eager=True)
    if callable(quota):
        quotas = quota({r[g]: r["n"] for r in cnt.groupBy(g).agg(F.sum("count").alias("n")).collect()})  # one row per stratum
    else:
        quotas = quota if isinstance(quota, dict) else {0: int(quota)}
    gtype = dict(d.dtypes)[g]
    qdf = spark.createDataFrame([(k, int(v)) for k, v in quotas.items()], f"{g} {gtype}, _quota long")
    small = sized_broadcast if by else F.broadcast  # a row a stratum; without strata one row
    w = Window.partitionBy(g).orderBy("_hb").rowsBetween(Window.unboundedPreceding, 0)
    cum = cnt.withColumn("_cum", F.sum("count").over(w)).join(small(qdf), g)
    bound = (cum.where((F.col("_cum") >= F.col("_quota")) & (F.col("_quota") > 0))
             .groupBy(g).agg(F.min_by(F.struct(F.col("_hb").alias("b"),
                                               (F.col("_quota") - F.col("_cum") + F.col("count")).alias("need")),
                                      "_hb").alias("_bd"))
             .select(g, F.col("_bd.b").alias("_hb"), F.col("_bd.need").alias("_need")))
    # the last selected row of each stratum: only the rows of its boundary bucket are ranked
    last = F.struct("_h", *order_keys)
    ranked = Window.partitionBy(g, "_hb").orderBy("_h", *order_keys)
    cut = (d.join(sized_broadcast(bound), [g, "_hb"]).withColumn("_rn", F.row_number().over(ranked))
           .where(F.col("_rn") == F.col("_need")).select(g, last.alias("_cut")))
    # one row per stratum: nothing selected for quota 0, all rows where there is no boundary
    info = qdf.join(cut, g, "left").select(g, (F.col("_quota") > 0).alias("_some"), "_cut").checkpoint(eager=True)
    if by:
        j = d.join(small(info), g, "left")
        chosen = F.col("_some") & (F.col("_cut").isNull() | (last <= F.col("_cut")))
    else:
        # a single stratum: its boundary is one row, used as a literal (no join at all)
        j, row = d, info.first()
        types = dict(d.dtypes)
        chosen = F.lit(bool(row["_some"]))
        if row["_cut"] is not None:
            limit = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in row["_cut"].asDict().items()])
            chosen = chosen & (last <= limit)
    out = j.withColumn(flag, F.coalesce(chosen, F.lit(False))).drop("_h", "_hb", "_some", "_cut", "_rowid")
    return out if by else out.drop(g)


def bottom_k(df: DataFrame, n: int, key, seed: int = 42) -> DataFrame:
    """The ``n`` rows of least (md5(key-seed), key), from one pass over ``df``.

    Bottom-k sets merge: every task keeps its n least rows (Spark's window group limit), ``MERGE_GROUPS`` groups of
    tasks keep theirs, and a top-n takes the rest."""
    keys = list(key) if isinstance(key, (list, tuple)) else [key]
    order = ["_h", *keys]
    tasks = df.withColumns({"_h": rank_hash(key, seed), "_group": F.spark_partition_id() % MERGE_GROUPS})
    least = Window.partitionBy("_group").orderBy(*order)
    kept = tasks.withColumn("_rn", F.row_number().over(least)).where(F.col("_rn") <= n)
    return kept.orderBy(*order).limit(n).drop("_h", "_group", "_rn")


def sample_n(df: DataFrame, n: int, key, seed: int = 42) -> DataFrame:
    """Uniform n-row sample without replacement (n capped by the row count).

    ``key``: a unique column, a list of columns, or None (see ``mark_by_hash_rank``).  Samples of up to ``BOTTOM_K``
    rows take one pass, larger ones the passes of ``mark_by_hash_rank``; both give the same rows."""
    if key is not None and n <= BOTTOM_K:
        return bottom_k(df, n, key, seed)
    return mark_by_hash_rank(df, key, seed, n).where("_selected").drop("_selected")


def test_mode_samples(train: DataFrame, test: DataFrame, key, sample_size: int = 5000,
                      seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Quick-run subsets: ``sample_size`` training rows, a quarter as many test rows."""
    return sample_n(train, sample_size, key, seed), sample_n(test, sample_size // 4, key, seed)


def split_quotas(counts: dict, test_size: float | None = None, train_size: int | float | None = None) -> dict:
    """Per-class test-side counts of a stratified split (sklearn's allocation)."""
    n = sum(counts.values())
    if train_size is not None and not isinstance(train_size, float):
        n_train = int(train_size)
        n_test = n - n_train
    else:
        ts = test_size if test_size is not None else 1.0 - float(train_size)
        n_test = math.ceil(ts * n)
        n_train = n - n_test
    train_alloc = approximate_mode(counts, n_train)
    return {k: counts[k] - train_alloc[k] for k in counts}


def stratified_split(df: DataFrame, key, label: str = "is_fraud", test_size: float = 0.2,
                     seed: int = 42, split_col: str = "split", counts: dict | None = None) -> DataFrame:
    """Add ``split`` in {'train','test'}; class counts are exact per stratum."""
    def quotas(sizes: dict) -> dict:
        check_classes(sizes)
        return split_quotas(sizes, test_size=test_size)
    m = mark_by_hash_rank(df, key, seed, split_quotas(counts, test_size=test_size) if counts else quotas,
                          by=label, flag="_t")
    return m.withColumn(split_col, F.when(F.col("_t"), "test").otherwise("train")).drop("_t")


def stratified_subset(df: DataFrame, key, label: str = "is_fraud", fraction: float = 0.95,
                      seed: int = 42, counts: dict | None = None) -> DataFrame:
    """Keep ``int(fraction * n)`` rows, stratified on ``label`` (the 'train' side)."""
    def quotas(sizes: dict) -> dict:
        return split_quotas(sizes, train_size=int(fraction * sum(sizes.values())))
    # as in ``stratified_split`` the lowest ranks form the held-out side
    m = mark_by_hash_rank(df, key, seed, quotas(counts) if counts else quotas, by=label, flag="_t")
    return m.where(~F.col("_t")).drop("_t")


def rare_class_sample(df: DataFrame, key, label: str = "is_fraud", fraction: float = 0.95,
                      rare_max: int = 5, seed: int = 42) -> DataFrame:
    """Fine-tune subset: if positives <= ``rare_max`` keep all of them plus
    sampled negatives up to ``int(fraction * n)``; else ``stratified_subset``."""
    counts = class_sizes(df, label)
    npos = counts.get(1, 0)
    if npos < 2:
        raise ValueError("Not enough positive examples (need at least 2).")
    n = sum(counts.values())
    if npos <= rare_max:
        cap = int(fraction * n)
        nneg = counts.get(0, 0)
        neg = sample_n(df.where(F.col(label) == 0), min(cap - npos, nneg), key, seed)
        return df.where(F.col(label) == 1).unionByName(neg)
    return stratified_subset(df, key, label, fraction, seed, counts=counts)


def balanced_reference(reference: DataFrame, current: DataFrame, key, ratio: float = 5,
                       seed: int = 42) -> DataFrame:
    """Down-sample the reference side to at most ``ratio`` times the current side."""
    n_ref, n_cur = reference.count(), current.count()
    n = min(n_ref, int(ratio * n_cur))
    return reference if n >= n_ref else sample_n(reference, n, key, seed)
