"""Registered queries: name -> (Spark callable, DuckDB oracle text or None).

Every callable takes ``(spark, sf_dir)``, reads the driver tables of that
folder in full and returns a DataFrame whose float columns are rounded to 6
digits for comparison.  Library operators themselves never round.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import age_years, haversine_km, round_floats, weekday_mon0
from riskframe.operators import augment as ag
from riskframe.operators import boosting as bo
from riskframe.operators import drift as dr
from riskframe.operators import encode as en
from riskframe.operators import features as fe
from riskframe.operators import metrics as me
from riskframe.operators import model as mo
from riskframe.operators import profile as pr
from riskframe.operators import sampling as sm
from riskframe.operators import score_drift as sd
from riskframe.plans.inputs import heuristic_predictions, year_halves
from riskframe.plans.oracle_sql import PRED_CTE, drift_ctes, md5_key, quota_cte, r6, split_ctes, with_views
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.transactions import transactions
from riskframe.streaming import jobs as st

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BOX_AMOUNT_LIMIT = 200000.0


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_floats(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def feats(spark, sf_dir):
    return fe.build_features(transactions(spark, sf_dir))


# ---------------------------------------------------------------- features
@register("features", with_views(
    f"SELECT trans_num, cc_num, merchant, category, {r6('amt')} AS amt, gender, state, zip, city_pop, job, "
    f"age, hour, dayofweek, month, {r6('distance_km')} AS distance_km, is_fraud FROM feats"))
def q_features(spark, sf_dir):
    """Raw transactions -> 14 features + label + key."""
    return feats(spark, sf_dir)


@register("haversine", with_views(
    f"SELECT trans_num, {r6('2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a))')} AS distance_km FROM ("
    "SELECT trans_num, pow(sin(radians(merch_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(merch_lat))"
    " * pow(sin(radians(merch_long - long) / 2), 2) AS a FROM tx) t"))
def q_haversine(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return tx.select("trans_num", haversine_km("lat", "long", "merch_lat", "merch_long").alias("distance_km"))


@register("time_parts", with_views(
    "SELECT trans_num, CAST(year(trans_date_trans_time) - year(dob) AS INTEGER) AS age, "
    "CAST(hour(trans_date_trans_time) AS INTEGER) AS hour, CAST(isodow(trans_date_trans_time) - 1 AS INTEGER) AS dayofweek, "
    "CAST(month(trans_date_trans_time) AS INTEGER) AS month, unix_time FROM tx"))
def q_time_parts(spark, sf_dir):
    f = fe.parse_times(transactions(spark, sf_dir))
    ts = F.col("trans_date_trans_time")
    return f.select("trans_num", age_years(ts, "dob").alias("age"), F.hour(ts).alias("hour"),
                    weekday_mon0(ts).alias("dayofweek"), F.month(ts).alias("month"), "unix_time")


# ---------------------------------------------------------------- profile
@register("class_counts", with_views("SELECT is_fraud, count(*) AS n FROM feats GROUP BY is_fraud"))
def q_class_counts(spark, sf_dir):
    return pr.class_counts(feats(spark, sf_dir))


@register("class_freq", with_views(
    f"SELECT category, count(*) AS n, {r6('count(*) / (SELECT count(*) FROM feats)')} AS freq "
    "FROM feats GROUP BY category"))
def q_class_freq(spark, sf_dir):
    """Normalised value counts (the weighted-draw distributions)."""
    return pr.value_frequencies(feats(spark, sf_dir), "category")


@register("label_freq", with_views(
    f"SELECT is_fraud, count(*) AS n, {r6('count(*) / (SELECT count(*) FROM feats)')} AS freq "
    "FROM feats GROUP BY is_fraud"))
def q_label_freq(spark, sf_dir):
    return pr.value_frequencies(feats(spark, sf_dir), "is_fraud")


@register("positive_rate", with_views(
    f"SELECT count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_pos, {r6('avg(is_fraud)')} AS pos_rate FROM feats"))
def q_positive_rate(spark, sf_dir):
    return pr.positive_rate(feats(spark, sf_dir))


@register("fraud_rate_by_category", with_views(
    f"SELECT category, {r6('avg(is_fraud)')} AS fraud_rate, count(*) AS n FROM feats GROUP BY category "
    "ORDER BY fraud_rate DESC, category"))
def q_fraud_rate_by_category(spark, sf_dir):
    """Flagship: positive rate per category, highest first."""
    return pr.rate_by_group(feats(spark, sf_dir), "category")


@register("daily_fraud", with_views(
    "SELECT c.day, coalesce(d.n_pos, 0) AS n_pos, coalesce(d.n_rows, 0) AS n_rows FROM "
    "(SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d) c "
    "LEFT JOIN d ON c.day = d.day",
    "d AS (SELECT CAST(trans_date_trans_time AS DATE) AS day, CAST(sum(is_fraud) AS BIGINT) AS n_pos, "
    "count(*) AS n_rows FROM tx GROUP BY 1)"))
def q_daily_fraud(spark, sf_dir):
    return pr.daily_counts(transactions(spark, sf_dir))


@register("amount_box", with_views(
    "SELECT category, n, " + ", ".join(f"{r6(c)} AS {c}" for c in ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"])
    + ", n_outliers FROM (SELECT q.category, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr, "
    "count(b.amt) AS n, min(CASE WHEN b.amt >= q.q1 - 1.5 * (q.q3 - q.q1) THEN b.amt END) AS whisker_lo, "
    "max(CASE WHEN b.amt <= q.q3 + 1.5 * (q.q3 - q.q1) THEN b.amt END) AS whisker_hi, "
    "CAST(sum(CASE WHEN b.amt < q.q1 - 1.5 * (q.q3 - q.q1) OR b.amt > q.q3 + 1.5 * (q.q3 - q.q1) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers "
    "FROM b JOIN q ON b.category = q.category GROUP BY q.category, q.q1, q.median, q.q3) s",
    f"b AS (SELECT category, amt FROM tx WHERE amt < {BOX_AMOUNT_LIMIT}), "
    "q AS (SELECT category, quantile_cont(amt, 0.25) AS q1, quantile_cont(amt, 0.5) AS median, "
    "quantile_cont(amt, 0.75) AS q3 FROM b GROUP BY category)"))
def q_amount_box(spark, sf_dir):
    """Box statistics of raw amounts below a limit, per category (exact quartiles)."""
    tx = fe.where_amount_below(transactions(spark, sf_dir), BOX_AMOUNT_LIMIT)
    return pr.box_stats(tx, "amt", "category", exact=True)


@register("age_density", with_views(
    f"SELECT is_fraud, bin, {r6('lo + bin * w')} AS bin_lo, {r6('lo + (bin + 1) * w')} AS bin_hi, n, "
    f"{r6('n / (n_class * w)')} AS density FROM (SELECT h.*, c.n_class, r.lo, "
    "CASE WHEN r.hi = r.lo THEN 1.0 ELSE (r.hi - r.lo) / 40.0 END AS w FROM h JOIN c USING (is_fraud), r) z",
    "r AS (SELECT CAST(min(age) AS DOUBLE) AS lo, CAST(max(age) AS DOUBLE) AS hi FROM feats), "
    "c AS (SELECT is_fraud, count(age) AS n_class FROM feats GROUP BY is_fraud), "
    "h AS (SELECT is_fraud, CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((age - r.lo) / ((r.hi - r.lo) / 40.0)), 39) END AS INTEGER) AS bin, "
    "count(*) AS n FROM feats, r GROUP BY 1, 2)"))
def q_age_density(spark, sf_dir):
    """Per-class density histogram of age, 40 common bins."""
    return pr.class_histogram(feats(spark, sf_dir), "age", bins=40)


@register("rate_ci_by_gender", with_views(
    f"SELECT gender, count(*) AS n, {r6('avg(is_fraud)')} AS rate, "
    f"{r6('avg(is_fraud) - 1.959963984540054 * coalesce(stddev_samp(is_fraud), 0) / sqrt(count(*))')} AS ci_lo, "
    f"{r6('avg(is_fraud) + 1.959963984540054 * coalesce(stddev_samp(is_fraud), 0) / sqrt(count(*))')} AS ci_hi "
    "FROM feats GROUP BY gender"))
def q_rate_ci_by_gender(spark, sf_dir):
    return pr.rate_with_interval(feats(spark, sf_dir), "gender")


_TX_COLS = ["trans_date_trans_time", "cc_num", "merchant", "category", "amt", "first", "last", "gender",
            "street", "city", "state", "zip", "lat", "long", "city_pop", "job", "dob", "trans_num",
            "unix_time", "merch_lat", "merch_long", "is_fraud"]
_TX_TYPES = {"trans_date_trans_time": "timestamp", "cc_num": "bigint", "amt": "double", "zip": "int",
             "lat": "double", "long": "double", "city_pop": "bigint", "dob": "date", "trans_num": "bigint",
             "unix_time": "bigint", "merch_lat": "double", "merch_long": "double", "is_fraud": "int"}


@register("cardinality", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT \"{c}\") AS n_distinct, '{_TX_TYPES.get(c, 'string')}' AS dtype, "
    f"{'count(DISTINCT \"' + c + '\") > 100' if c not in _TX_TYPES else 'false'} AS high_cardinality FROM tx"
    for c in _TX_COLS)))
def q_cardinality(spark, sf_dir):
    """Distinct values of every raw column; text columns over 100 flagged."""
    return pr.cardinality(transactions(spark, sf_dir))


@register("high_cardinality", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT \"{c}\") > 100 AS high_cardinality FROM tx" for c in _TX_COLS)))
def q_high_cardinality(spark, sf_dir):
    """Columns with over 100 distinct values, from one pass of sketches and exact counts near the limit."""
    return pr.high_cardinality(transactions(spark, sf_dir)).select("column_name", "high_cardinality")


_PREVIEW_COLS = ["merchant", "category", "first", "last", "gender", "street", "city", "state", "job"]


@register("value_preview", with_views(
    "SELECT column_name, CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) AS INTEGER) AS pos, value "
    "FROM (SELECT DISTINCT column_name, value FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, \"{c}\" AS value FROM tx" for c in _PREVIEW_COLS)
    + ") u WHERE value IS NOT NULL) d QUALIFY pos <= 5"))
def q_value_preview(spark, sf_dir):
    """First five distinct values of every text column."""
    return pr.value_preview(transactions(spark, sf_dir), _PREVIEW_COLS, 5)


@register("merchant_pool", with_views("SELECT DISTINCT merchant FROM tx WHERE merchant IS NOT NULL"))
def q_merchant_pool(spark, sf_dir):
    return pr.distinct_values(transactions(spark, sf_dir), "merchant")


@register("city_tuples", with_views(
    f"SELECT DISTINCT city, {r6('lat')} AS lat, {r6('long')} AS long FROM tx "
    "WHERE city IS NOT NULL AND lat IS NOT NULL AND long IS NOT NULL"))
def q_city_tuples(spark, sf_dir):
    return pr.distinct_tuples(transactions(spark, sf_dir), ["city", "lat", "long"])


# ---------------------------------------------------------------- sampling

SAMPLE_N = 5000


@register("sample_n", with_views(
    f"SELECT trans_num, is_fraud FROM feats QUALIFY row_number() OVER (ORDER BY {md5_key('trans_num')}, trans_num) <= {SAMPLE_N}"))
def q_sample_n(spark, sf_dir):
    """Seeded uniform sample of n rows without replacement."""
    return sm.sample_n(feats(spark, sf_dir), SAMPLE_N, "trans_num", 42).select("trans_num", "is_fraud")


@register("test_mode_sample", with_views(
    f"SELECT trans_num, split FROM sp QUALIFY row_number() OVER (PARTITION BY split ORDER BY {md5_key('trans_num')}, "
    f"trans_num) <= CASE WHEN split = 'train' THEN {SAMPLE_N} ELSE {SAMPLE_N // 4} END", split_ctes()))
def q_test_mode_sample(spark, sf_dir):
    """Quick-run mode: 5000 training rows and 1250 test rows of a split."""
    sp = sm.stratified_split(feats(spark, sf_dir), "trans_num")
    tr, te = sm.test_mode_samples(sp.where("split = 'train'"), sp.where("split = 'test'"), "trans_num", SAMPLE_N)
    return tr.unionByName(te).select("trans_num", "split")


@register("stratified_split", with_views("SELECT trans_num, is_fraud, split FROM sp", split_ctes()))
def q_stratified_split(spark, sf_dir):
    """80/20 split stratified on the label, exact class counts."""
    return sm.stratified_split(feats(spark, sf_dir), "trans_num").select("trans_num", "is_fraud", "split")


@register("stratified_subset", with_views(
    f"SELECT f.trans_num, f.is_fraud FROM feats f JOIN q USING (is_fraud) "
    f"QUALIFY row_number() OVER (PARTITION BY f.is_fraud ORDER BY {md5_key('f.trans_num')}, f.trans_num) > q.quota",
    quota_cte("q", "feats", "sum(n) - CAST(floor(CAST(0.95 AS DOUBLE) * sum(n)) AS BIGINT)")))
def q_stratified_subset(spark, sf_dir):
    """Stratified 95 % subset (fine-tune training rows)."""
    return sm.stratified_subset(feats(spark, sf_dir), "trans_num").select("trans_num", "is_fraud")


@register("rare_class_sample", ORACLE.get("stratified_subset"))
def q_rare_class_sample(spark, sf_dir):
    """Fine-tune sampling: all positives + negatives when positives are rare,
    else the stratified 95 % subset (the branch taken on these tables)."""
    return sm.rare_class_sample(feats(spark, sf_dir), "trans_num").select("trans_num", "is_fraud")


@register("balanced_reference", with_views(
    f"SELECT trans_num FROM r QUALIFY row_number() OVER (ORDER BY {md5_key('trans_num')}, trans_num) <= "
    "(SELECT least((SELECT count(*) FROM r), 5 * (SELECT count(*) FROM c)))",
    "r AS (SELECT * FROM tx WHERE year(trans_date_trans_time) % 2 = 0), "
    "c AS (SELECT * FROM tx WHERE year(trans_date_trans_time) % 2 = 1)"))
def q_balanced_reference(spark, sf_dir):
    """Reference side down-sampled to at most 5x the current side."""
    ref, cur = year_halves(transactions(spark, sf_dir))
    return sm.balanced_reference(ref, cur, "trans_num").select("trans_num")


_FEW_GROUP = ("grp AS (SELECT state, category, count(*) AS n, sum(is_fraud) AS n_pos FROM feats GROUP BY 1, 2 "
              "HAVING sum(is_fraud) BETWEEN 2 AND 5 ORDER BY 1, 2 LIMIT 1)")


@register("rare_class_sample_few", with_views(
    "SELECT f.trans_num, f.is_fraud FROM feats f JOIN grp USING (state, category) QUALIFY f.is_fraud = 1 OR "
    f"row_number() OVER (PARTITION BY f.is_fraud ORDER BY {md5_key('f.trans_num')}, f.trans_num) "
    "<= least(CAST(floor(CAST(0.95 AS DOUBLE) * n) AS BIGINT) - n_pos, n - n_pos)", _FEW_GROUP))
def q_rare_class_sample_few(spark, sf_dir):
    """The rare branch: the first (state, category) with two to five positives keeps all of them, and negatives up to 95 %."""
    f = feats(spark, sf_dir).select("trans_num", "is_fraud", "state", "category")
    some = f.groupBy("state", "category").agg(F.sum("is_fraud").alias("n_pos")).where("n_pos between 2 and 5")
    group = some.orderBy("state", "category").first()  # one row
    if group is None:
        return f.where("false").select("trans_num", "is_fraud")
    mine = f.where((F.col("state") == group["state"]) & (F.col("category") == group["category"]))
    return sm.rare_class_sample(mine, "trans_num").select("trans_num", "is_fraud")


@register("balanced_reference_down", with_views(
    f"SELECT trans_num FROM r QUALIFY row_number() OVER (ORDER BY {md5_key('trans_num')}, trans_num) <= "
    "(SELECT least((SELECT count(*) FROM r), 2 * (SELECT count(*) FROM c)))",
    "r AS (SELECT * FROM tx WHERE category <> '1-URGENT'), c AS (SELECT * FROM tx WHERE category = '1-URGENT')"))
def q_balanced_reference_down(spark, sf_dir):
    """Reference rows (not urgent) really down-sampled, to twice the urgent ones."""
    tx = transactions(spark, sf_dir)
    urgent = F.col("category") == "1-URGENT"
    return sm.balanced_reference(tx.where(~urgent), tx.where(urgent), "trans_num", ratio=2).select("trans_num")


# ---------------------------------------------------------------- encoder
_ENC_COLS = fe.CATEGORICAL_COLUMNS
_UNPIVOT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, is_fraud FROM sp WHERE split = 'train'" for c in _ENC_COLS)
_ENC_CTE = (split_ctes() + ", "
            f"pri AS (SELECT avg(is_fraud) AS prior FROM sp WHERE split = 'train'), "
            f"st AS (SELECT feature, value, count(*) AS n, avg(is_fraud) AS mean FROM ({_UNPIVOT_SQL}) u "
            "WHERE value IS NOT NULL GROUP BY 1, 2), "
            "enc AS (SELECT st.*, pri.prior, pri.prior * (1 - 1 / (1 + exp(-(n - 20.0) / 10.0))) "
            "+ mean * (1 / (1 + exp(-(n - 20.0) / 10.0))) AS enc FROM st, pri)")


def _split_feats(spark, sf_dir):
    return sm.stratified_split(feats(spark, sf_dir), "trans_num")


@register("encoder_fit", with_views(
    f"SELECT feature, value, n, {r6('mean')} AS mean, {r6('prior')} AS prior, {r6('enc')} AS enc FROM enc", _ENC_CTE))
def q_encoder_fit(spark, sf_dir):
    """Target encoder fitted on the training split only."""
    sp = _split_feats(spark, sf_dir)
    return en.fit_target_encoder(sp.where("split = 'train'")).select("feature", "value", "n", "mean", "prior", "enc")


@register("encoder_apply", with_views(
    "SELECT t.trans_num, " + ", ".join(
        f"{r6(f'coalesce(e_{c}.enc, (SELECT prior FROM pri))')} AS {c}" for c in _ENC_COLS)
    + " FROM sp t " + " ".join(
        f"LEFT JOIN (SELECT value, enc FROM enc WHERE feature = '{c}') e_{c} ON CAST(t.{c} AS VARCHAR) = e_{c}.value"
        for c in _ENC_COLS) + " WHERE t.split = 'test'", _ENC_CTE))
def q_encoder_apply(spark, sf_dir):
    """Test split encoded with the train-only encoder; unseen -> prior."""
    sp = _split_feats(spark, sf_dir)
    enc = en.fit_target_encoder(sp.where("split = 'train'"))
    return en.apply_target_encoder(sp.where("split = 'test'"), enc).select("trans_num", *_ENC_COLS)


# ---------------------------------------------------------------- metrics
@register("classification_report", with_views(
    "SELECT label, precision, recall, f1, support FROM ("
    f"SELECT CAST(cls AS VARCHAR) AS label, {r6('CASE WHEN n_pred = 0 THEN 0 ELSE tp / n_pred END')} AS precision, "
    f"{r6('CASE WHEN support = 0 THEN 0 ELSE tp / support END')} AS recall, "
    f"{r6('CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END')} AS f1, CAST(support AS BIGINT) AS support FROM pc "
    f"UNION ALL SELECT 'accuracy', NULL, NULL, {r6('sum(tp) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM pc "
    f"UNION ALL SELECT 'macro avg', {r6('avg(p)')}, {r6('avg(r)')}, {r6('avg(f)')}, CAST(sum(support) AS BIGINT) FROM pc "
    f"UNION ALL SELECT 'weighted avg', {r6('sum(p * support) / sum(support)')}, {r6('sum(r * support) / sum(support)')}, "
    f"{r6('sum(f * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM pc) z",
    PRED_CTE + ", "
    "cf AS (SELECT y_true, y_pred_binary, count(*) AS c FROM preds GROUP BY 1, 2), "
    "ca AS (SELECT y_true AS cls, sum(c) AS support, sum(CASE WHEN y_true = y_pred_binary THEN c ELSE 0 END) AS tp FROM cf GROUP BY 1), "
    "cb AS (SELECT y_pred_binary AS cls, sum(c) AS n_pred FROM cf GROUP BY 1), "
    "pc0 AS (SELECT coalesce(ca.cls, cb.cls) AS cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, "
    "coalesce(n_pred, 0) AS n_pred FROM ca FULL JOIN cb ON ca.cls = cb.cls), "
    "pc1 AS (SELECT *, CASE WHEN n_pred = 0 THEN 0.0 ELSE tp / n_pred END AS p, "
    "CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r FROM pc0), "
    "pc AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM pc1)"))
def q_classification_report(spark, sf_dir):
    """Per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    return me.classification_report(heuristic_predictions(transactions(spark, sf_dir)))


_AUC_SQL = (PRED_CTE + ", s AS (SELECT y_pred_proba AS s, CAST(sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos, "
            "CAST(sum(CASE WHEN y_true = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM preds GROUP BY 1), "
            "rs AS (SELECT *, sum(neg) OVER (ORDER BY s) AS cum_neg FROM s), "
            "au AS (SELECT sum(pos * (cum_neg - neg + 0.5 * neg)) AS u, sum(pos) AS n_pos, sum(neg) AS n_neg FROM rs)")


@register("roc_auc", with_views(
    f"SELECT {r6('CASE WHEN n_pos = 0 OR n_neg = 0 THEN NULL ELSE u / (n_pos * n_neg) END')} AS roc_auc, "
    "CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg FROM au", _AUC_SQL))
def q_roc_auc(spark, sf_dir):
    """Exact ROC AUC of pre-computed scores (ties count one half)."""
    return me.roc_auc(heuristic_predictions(transactions(spark, sf_dir)))


# ---------------------------------------------------------------- drift

_DRIFT_NUM = ["cc_num", "amt", "zip", "city_pop", "age", "hour", "dayofweek", "month", "distance_km"]
_DRIFT_CAT = ["merchant", "category", "gender", "state", "job"]
_DRIFT_COLS = [c for c in fe.FEATURE_COLUMNS]
_YEAR_FEATS = ("fy AS (SELECT f.*, year(t.trans_date_trans_time) AS yr FROM feats f JOIN tx t USING (trans_num)), "
               "fr AS (SELECT * FROM fy WHERE yr % 2 = 0), fc AS (SELECT * FROM fy WHERE yr % 2 = 1)")


def _drift_sql(body: str, stattest: str | dict | None = None) -> str:
    return with_views(body, _YEAR_FEATS + ", " + drift_ctes(_DRIFT_NUM, _DRIFT_CAT, "fr", "fc", stattest))


def _year_feature_pair(spark, sf_dir):
    ref, cur = year_halves(transactions(spark, sf_dir))
    return fe.build_features(ref), fe.build_features(cur)


def _vc(spark, sf_dir):
    ref, cur = _year_feature_pair(spark, sf_dir)
    return ref, cur, dr.value_counts(ref, cur, _DRIFT_COLS)


_TABLE_BODY = (
    "SELECT s.column_name, s.kind AS column_type, CASE s.test WHEN 'wasserstein' THEN 'Wasserstein distance (normed)' "
    "WHEN 'jensenshannon' THEN 'Jensen-Shannon distance' WHEN 'ks' THEN 'K-S p_value' WHEN 'chisquare' THEN "
    "'chi-square p_value' ELSE 'Z-test p_value' END AS stattest_name, CAST(0.1 AS DOUBLE) AS stattest_threshold, "
    f"{r6('coalesce(wd.score, js.score)')} AS drift_score, coalesce(coalesce(wd.score, js.score) >= 0.1, false) AS drift_detected "
    "FROM summ s LEFT JOIN wd USING (column_name) LEFT JOIN js USING (column_name)")


@register("drift_table", _drift_sql(_TABLE_BODY))
def q_drift_table(spark, sf_dir):
    """Per-column drift (test chosen per column) between even and odd years."""
    ref, cur, vc = _vc(spark, sf_dir)
    return dr.drift_table(ref, cur, _DRIFT_COLS, vc=vc)


@register("drift_wasserstein", _drift_sql(f"SELECT column_name, {r6('score')} AS score FROM wd"))
def q_drift_wasserstein(spark, sf_dir):
    """Normed Wasserstein distance of the numeric columns."""
    ref, cur, vc = _vc(spark, sf_dir)
    plan = dr.choose_test(dr.column_summary(vc))
    return dr.wasserstein_scores(vc, plan)


@register("drift_js", _drift_sql(f"SELECT column_name, {r6('score')} AS score FROM js"))
def q_drift_js(spark, sf_dir):
    """Jensen-Shannon distance of the text columns."""
    ref, cur, vc = _vc(spark, sf_dir)
    plan = dr.choose_test(dr.column_summary(vc))
    return dr.js_scores(vc, plan)


@register("drift_js_numeric", _drift_sql(f"SELECT column_name, {r6('score')} AS score FROM js", "jensenshannon"))
def q_drift_js_numeric(spark, sf_dir):
    """Jensen-Shannon on every column (numeric ones on 30 common bins)."""
    ref, cur, vc = _vc(spark, sf_dir)
    plan = dr.choose_test(dr.column_summary(vc), "jensenshannon")
    return dr.js_scores(vc, plan)


@register("drift_ks_stat", _drift_sql(f"SELECT column_name, {r6('stat')} AS stat FROM ks", "ks"))
def q_drift_ks_stat(spark, sf_dir):
    """Two-sample KS statistic (max CDF gap) of the numeric columns."""
    ref, cur, vc = _vc(spark, sf_dir)
    plan = dr.choose_test(dr.column_summary(vc), "ks")
    return dr.ks_statistics(vc, plan)


@register("drift_verdict", _drift_sql(
    f"SELECT CAST(count(*) AS INTEGER) AS n_columns, CAST(sum(CAST(d AS INTEGER)) AS INTEGER) AS n_drifted, "
    f"{r6('sum(CAST(d AS INTEGER)) / count(*)')} AS share, CAST(0.2 AS DOUBLE) AS drift_share, "
    "sum(CAST(d AS INTEGER)) / count(*) >= 0.2 AS dataset_drift, "
    "coalesce(string_agg(CASE WHEN d THEN column_name END, ',' ORDER BY column_name), '') AS drifted_columns "
    "FROM (SELECT column_name, coalesce(coalesce(wd.score, js.score) >= 0.1, false) AS d FROM summ "
    "LEFT JOIN wd USING (column_name) LEFT JOIN js USING (column_name)) z"))
def q_drift_verdict(spark, sf_dir):
    """Dataset drift verdict (share of drifted columns >= 0.2)."""
    ref, cur, vc = _vc(spark, sf_dir)
    v = dr.drift_verdict(dr.drift_table(ref, cur, _DRIFT_COLS, vc=vc))
    return v.withColumn("drifted_columns", F.array_join("drifted_columns", ","))


_HIST_CTES = (
    "sd AS (SELECT column_name, num, 'reference' AS side, n_ref AS c FROM vc WHERE kind = 'num' AND n_ref > 0 "
    "UNION ALL SELECT column_name, num, 'current', n_cur FROM vc WHERE kind = 'num' AND n_cur > 0), "
    "rg AS (SELECT column_name, side, sum(c) AS n, CASE WHEN min(num) = max(num) THEN min(num) - 0.5 ELSE min(num) END AS lo, "
    "CASE WHEN min(num) = max(num) THEN max(num) + 0.5 ELSE max(num) END AS hi FROM sd GROUP BY 1, 2), "
    "h AS (SELECT column_name, side, CAST(least(floor((num - lo) / (hi - lo) * 10), 9) AS INTEGER) AS bin, sum(c) AS k "
    "FROM sd JOIN rg USING (column_name, side) GROUP BY 1, 2, 3)")


@register("drift_hist", with_views(
    f"SELECT column_name, side, bin, {r6('lo + bin * (hi - lo) / 10')} AS bin_lo, "
    f"{r6('lo + (bin + 1) * (hi - lo) / 10')} AS bin_hi, {r6('coalesce(k, 0) / (n * (hi - lo) / 10)')} AS density "
    "FROM (SELECT g.*, h.k FROM (SELECT rg.*, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM rg) g "
    "LEFT JOIN h USING (column_name, side, bin)) z",
    _YEAR_FEATS + ", " + drift_ctes(_DRIFT_NUM, _DRIFT_CAT, "fr", "fc") + ", " + _HIST_CTES))
def q_drift_hist(spark, sf_dir):
    """10-bin density histograms per numeric column and side."""
    ref, cur, vc = _vc(spark, sf_dir)
    return dr.drift_histograms(vc)


# ---------------------------------------------------------------- models


@register("validate_predictions", with_views(
    f"SELECT {r6('CASE WHEN n_pos = 0 OR n_neg = 0 THEN NULL ELSE u / (n_pos * n_neg) END')} AS roc_auc, "
    "CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, "
    f"{r6('(SELECT CASE WHEN sum(y_pred_binary) = 0 THEN 0 ELSE sum(y_true * y_pred_binary) / sum(y_pred_binary) END FROM preds)')} AS precision_1, "
    f"{r6('(SELECT CASE WHEN sum(y_true) = 0 THEN 0 ELSE sum(y_true * y_pred_binary) / sum(y_true) END FROM preds)')} AS recall_1, "
    f"{r6('(SELECT CASE WHEN sum(y_true) + sum(y_pred_binary) = 0 THEN 0 ELSE 2 * sum(y_true * y_pred_binary) / (sum(y_true) + sum(y_pred_binary)) END FROM preds)')} AS f1_1, "
    f"{r6('(SELECT avg(CASE WHEN y_true = y_pred_binary THEN 1 ELSE 0 END) FROM preds)')} AS accuracy, "
    f"{r6('CASE WHEN n_pos = 0 OR n_neg = 0 THEN NULL ELSE u / (n_pos * n_neg) END - 0.74')} AS auc_delta FROM au",
    _AUC_SQL))
def q_validate_predictions(spark, sf_dir):
    """Production validation of pre-computed predictions: AUC, class-1 metrics, accuracy, AUC delta."""
    return me.evaluate_predictions(heuristic_predictions(transactions(spark, sf_dir)))


def _encoded_splits(spark, sf_dir):
    sp = _split_feats(spark, sf_dir).checkpoint(eager=True)
    out = en.apply_target_encoder(sp, en.fit_target_encoder(sp.where("split = 'train'"))).checkpoint(eager=True)
    return out.where("split = 'train'").drop("split"), out.where("split = 'test'").drop("split")


def _train_evaluate(spark, sf_dir, preset):
    train, test = _encoded_splits(spark, sf_dir)
    # a stratified tenth of the train split stops the boosting; the test split is only scored
    cut = sm.stratified_split(train, "trans_num", "is_fraud", 0.1, seed=7, split_col="_part").checkpoint(eager=True)
    fit, validation = (cut.where(F.col("_part") == s).drop("_part") for s in ("train", "test"))
    model, info = mo.fit_boosted(fit, validation, fe.FEATURE_COLUMNS, preset=preset)
    report, _ = mo.evaluate_scored(mo.score(model, test))
    return report.withColumns({"best_round": F.lit(info["best_round"]), "rounds_run": F.lit(info["rounds_run"]),
                               "best_val_auc": F.lit(info["best_auc"]).cast("double")})


@register("train_evaluate")
def q_train_evaluate(spark, sf_dir):
    """Fit boosted trees (test preset) on the encoded train split, report on the test split, with the best round."""
    return _train_evaluate(spark, sf_dir, "test")


@register("train_evaluate_fast")
def q_train_evaluate_fast(spark, sf_dir):
    """As train_evaluate, at the fast preset (150 rounds of depth 5)."""
    return _train_evaluate(spark, sf_dir, "fast")


@register("train_evaluate_full")
def q_train_evaluate_full(spark, sf_dir):
    """As train_evaluate, at the full preset (up to 500 rounds of depth 6, 50 of patience), that of a training run."""
    return _train_evaluate(spark, sf_dir, "full")


@register("batch_score")
def q_batch_score(spark, sf_dir):
    """Score every test-split row: predicted class and probability of fraud."""
    train, test = _encoded_splits(spark, sf_dir)
    model = mo.fit_gbt(train, fe.FEATURE_COLUMNS, preset="test")
    return mo.score(model, test).select("trans_num", "is_fraud", "is_fraud_pred", "fraud_score")


@register("fine_tune")
def q_fine_tune(spark, sf_dir):
    """Continue a fitted model for up to 10 rounds on the stratified 95 % subset; summary row."""
    train, test = _encoded_splits(spark, sf_dir)
    base = mo.fit_gbt(train, fe.FEATURE_COLUMNS, preset="test")
    subset = sm.rare_class_sample(train, "trans_num").checkpoint(eager=True)
    cut = sm.stratified_split(subset, "trans_num", "is_fraud", 0.1, seed=7, split_col="_part").checkpoint(eager=True)
    fit, validation = (cut.where(F.col("_part") == s).drop("_part") for s in ("train", "test"))
    cont, info = mo.fine_tune(base, fit, validation, learning_rate=0.01, epochs=10)
    _, summary = mo.evaluate_scored(mo.score(cont, test))
    return mo.fit_summary(summary, {}).drop("params").withColumns(
        {"rounds_run": F.lit(info["rounds_run"]), "rounds_kept": F.lit(info["rounds_kept"])})


#: an ensemble stated in full, as (feature, limit, left, right) or a leaf, and its rate
_FIXED_FEATURES = ["amt", "distance_km", "month", "age"]
_FIXED_TREES = [
    (("amt", 12.0, ("month", 6.0, -1.25, -0.5), ("age", 30.0, 0.75, 1.5)), 0.5),
    (("distance_km", 5000.0, ("month", 3.0, -0.5, 0.25), ("amt", 12.25, 0.125, 1.0)), 0.25),
    (("age", 40.0, 0.375, ("amt", 12.4, -0.75, 0.625)), 1.0),
]


def _fixed_model() -> bo.Boosted:
    def grow(nodes, x):
        here = len(nodes)
        nodes.append((-1, 0.0, -1, -1, float(x) if not isinstance(x, tuple) else 0.0))
        if isinstance(x, tuple):
            left = grow(nodes, x[2])
            right = grow(nodes, x[3])
            nodes[here] = (_FIXED_FEATURES.index(x[0]), x[1], left, right, 0.0)
        return here
    trees = []
    for shape, _ in _FIXED_TREES:
        nodes: list = []
        grow(nodes, shape)
        trees.append(bo.tree_of(nodes))
    return bo.Boosted(_FIXED_FEATURES, trees, [r for _, r in _FIXED_TREES])


def _case(x) -> str:
    return f"(CASE WHEN {x[0]} <= {x[1]} THEN {_case(x[2])} ELSE {_case(x[3])} END)" if isinstance(x, tuple) else f"CAST({x} AS DOUBLE)"


def _leaf_case(x, first: int = 0) -> tuple[str, int]:
    """The number of the leaf that a row reaches, and the next free number."""
    if not isinstance(x, tuple):
        return str(first), first + 1
    left, n = _leaf_case(x[2], first)
    right, n = _leaf_case(x[3], n)
    return f"(CASE WHEN {x[0]} <= {x[1]} THEN {left} ELSE {right} END)", n


_STAGES = [" + ".join(f"{r} * {_case(x)}" for x, r in _FIXED_TREES[:i]) for i in range(1, len(_FIXED_TREES) + 1)]
_SCORED = f"SELECT trans_num, is_fraud, {_STAGES[-1]} AS m FROM feats"
_SCORE_COLS = (f"trans_num, is_fraud, CAST(m > 0 AS INTEGER) AS is_fraud_pred, {r6('1 / (1 + exp(-m))')} AS fraud_score, {r6('m')} AS margin")


@register("score_fixed_trees", with_views(f"SELECT {_SCORE_COLS} FROM s", f"s AS ({_SCORED})"))
def q_score_fixed_trees(spark, sf_dir):
    """Every transaction scored by a stated ensemble: margin, probability and class."""
    model, f = _fixed_model(), feats(spark, sf_dir)
    scored = mo.score(model, f.withColumn("margin", model.margin(f)))
    return scored.select("trans_num", "is_fraud", "is_fraud_pred", "fraud_score", "margin")


@register("score_fixed_stream", with_views(f"SELECT {_SCORE_COLS.rsplit(', ', 2)[0]} FROM s", f"s AS ({_SCORED})"))
def q_score_fixed_stream(spark, sf_dir):
    """The stated ensemble, stored, loaded and applied to the transaction stream."""
    root = _scratch(spark, "score-fixed")
    mo.save_model(_fixed_model(), f"{root}/model")
    scored = st.score_stream(st.features_stream(spark, sf_dir), mo.load_model(f"{root}/model"))
    st.run_available_now(scored.select("trans_num", "is_fraud", "is_fraud_pred", "fraud_score"), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@register("staged_auc", with_views(
    "SELECT CAST(stage AS INTEGER) AS stage, CASE WHEN n_pos = 0 OR n_neg = 0 THEN NULL ELSE "
    f"{r6('u / (CAST(n_pos AS DOUBLE) * n_neg)')} END AS roc_auc, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg FROM ("
    "SELECT stage, sum(pos * (before + 0.5 * neg)) AS u, sum(pos) AS n_pos, sum(neg) AS n_neg FROM ("
    "SELECT *, sum(neg) OVER (PARTITION BY stage ORDER BY m) - neg AS before FROM ("
    "SELECT stage, m, sum(is_fraud) AS pos, sum(1 - is_fraud) AS neg FROM st GROUP BY 1, 2) a) b GROUP BY 1) c",
    "st AS (" + " UNION ALL ".join(f"SELECT {i} AS stage, is_fraud, {x} AS m FROM feats" for i, x in enumerate(_STAGES, 1)) + ")"))
def q_staged_auc(spark, sf_dir):
    """AUC after each tree of the stated ensemble, all from one running sum."""
    model, f = _fixed_model(), feats(spark, sf_dir)
    return me.staged_auc(f.select("is_fraud", model.staged_margins(f).alias("m")), "m", "is_fraud").select(
        F.col("stage").cast("int").alias("stage"), "roc_auc", "n_pos", "n_neg")


_REFIT = (f"s AS (SELECT is_fraud AS y, 1 / (1 + exp(-({_STAGES[1]}))) AS p, CASE WHEN is_fraud = 1 THEN 15.0 ELSE 1.0 END AS w, "
          f"{_leaf_case(_FIXED_TREES[2][0])[0]} AS leaf FROM feats)")


@register("refit_leaves", with_views(
    f"SELECT CAST(leaf AS INTEGER) AS leaf, {r6('sum(w * (y - p)) / (sum(w * p * (1 - p)) + 10)')} AS value FROM s GROUP BY 1", _REFIT))
def q_refit_leaves(spark, sf_dir):
    """Leaves of the third stated tree, re-fitted by a Newton step with L2 = 10 on top of the first two."""
    model, f = _fixed_model(), feats(spark, sf_dir)
    base = bo.Boosted(model.features, model.trees[:2], model.rates[:2])
    step = bo.Boosted(model.features, [model.trees[2].with_leaves(range(len(model.trees[2].leaves)))], [1.0])
    rows = fe.class_weight(f, 15.0).select("is_fraud", "weight", base.margin(f).alias("margin"), step.margin(f).cast("int").alias("leaf"))
    return bo.leaf_values(rows, "leaf", "margin", "is_fraud", "weight", 10.0)


# ---------------------------------------------------------------- augmentation

_U = "CAST(('0x' || substr(md5(concat(CAST(trans_num AS VARCHAR), '-{tag}')), 1, 13)) AS BIGINT) / 4503599627370496.0"


def _u(tag: str) -> str:
    return _U.format(tag=tag)


def _g(tag: str) -> str:
    return (f"(sqrt(-2.0 * ln(greatest({_u(tag + '-a')}, 1e-300))) * cos(2 * pi() * {_u(tag + '-b')}))")


@register("weighted_draw", with_views(
    "SELECT t.trans_num, dd.value AS drawn FROM (SELECT trans_num, " + _u("42-category") + " AS u FROM tx) t "
    "JOIN dd ON t.u >= dd.lo AND t.u < dd.hi",
    "d AS (SELECT category AS value, count(*) AS n FROM tx WHERE category IS NOT NULL GROUP BY 1), "
    "dd AS (SELECT value, (sum(n) OVER (ORDER BY value ROWS UNBOUNDED PRECEDING) - n) / (SELECT sum(n) FROM d) AS lo, "
    "sum(n) OVER (ORDER BY value ROWS UNBOUNDED PRECEDING) / (SELECT sum(n) FROM d) AS hi FROM d)"))
def q_weighted_draw(spark, sf_dir):
    """Per row, a category drawn from the observed category distribution (hash-seeded)."""
    tx = transactions(spark, sf_dir)
    drawn = ag.weighted_draw(tx.select("trans_num"), ag.distribution(tx, "category"), "trans_num", 42, "category", "drawn")
    return drawn


_V = 0.5


@register("jitter", with_views(
    f"SELECT trans_num, {r6('lat2')} AS lat, {r6('long2')} AS long, {r6('amt2')} AS amt, city_pop2 AS city_pop, "
    f"{r6('lat2 + (' + _u('42-merch_lat') + ' * 2 - 1) * 0.001')} AS merch_lat, "
    f"{r6('long2 + (' + _u('42-merch_long') + ' * 2 - 1) * 0.001')} AS merch_long FROM ("
    f"SELECT trans_num, lat + {_g('42-lat')} * 0.0005 AS lat2, long + {_g('42-long')} * 0.0005 AS long2, "
    f"round(greatest(0.01, amt + {_g('42-amt')} * 5.0), 2) AS amt2, "
    f"CAST(trunc(city_pop + {_g('42-city_pop')} * 500.0) AS BIGINT) AS city_pop2 FROM tx) z"))
def q_jitter(spark, sf_dir):
    """Numeric jitter at variability 0.5 (coordinates, amount, population, merchant point)."""
    tx = transactions(spark, sf_dir)
    return ag.jitter(tx, _V, "trans_num", 42).select("trans_num", "lat", "long", "amt", "city_pop", "merch_lat", "merch_long")


@register("synthetic_like")
def q_synthetic_like(spark, sf_dir):
    """1000 synthetic-like rows (variability 0.5) drawn from the whole table."""
    tx = transactions(spark, sf_dir)
    return ag.synthesize(tx, 1000, 0.5, "trans_num", 42, as_of=F.lit("2024-01-01 00:00:00").cast("timestamp"))


@register("synthetic_random")
def q_synthetic_random(spark, sf_dir):
    """1000 fully random rows (variability 1) over the table's value pools."""
    tx = transactions(spark, sf_dir)
    return ag.synthesize(tx, 1000, 1.0, "trans_num", 42, as_of=F.lit("2024-01-01 00:00:00").cast("timestamp"))


@register("synthetic_mix")
def q_synthetic_mix(spark, sf_dir):
    """1000 rows: a seeded real share plus fully synthetic rows, flagged."""
    tx = transactions(spark, sf_dir)
    return ag.mix_real_synthetic(tx, 1000, "trans_num", 42)


# ---------------------------------------------------------------- streaming


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


@register("features_stream", ORACLE["features"])
def q_features_stream(spark, sf_dir):
    """The feature builder run as a stream (orders stream x static dimensions)."""
    root = _scratch(spark, "features")
    st.run_available_now(st.features_stream(spark, sf_dir), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@register("events_daily_stream",
          "SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n, "
          f"{r6('sum(value)')} AS value_sum FROM events GROUP BY 1, 2")
def q_events_daily_stream(spark, sf_dir):
    """Watermarked daily event counts per type, as a stream over the events table."""
    root = _scratch(spark, "events")
    ev = st.table_stream(spark, sf_dir, "events")
    st.run_updates_available_now(st.daily_event_counts(ev), f"{root}/changes", f"{root}/ckpt")
    return st.latest_state(spark.read.parquet(f"{root}/changes"), ["day", "event_type"])


_QS, _GRID = (25, 50, 75, 95), range(1, 20)


@register("score_drift_months", with_views(
    "SELECT w.w AS \"window\", w.n AS n_rows, w.n_pos, " + f"{r6('w.total')} AS score_sum, {r6('CAST(w.n_pos AS DOUBLE) / w.n')} AS pos_rate, "
    + ", ".join(f"{r6(f'w.p{q}')} AS p{q}" for q in _QS) + f", {r6('g.gap')} AS distance, g.gap >= 0.1 AS drift FROM w JOIN g USING (w)",
    PRED_CTE + ", s AS (SELECT CAST(date_trunc('month', t.trans_date_trans_time) AS DATE) AS w, p.y_true, p.y_pred_proba AS x "
    "FROM preds p JOIN tx t USING (trans_num)), "
    "o AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY x) AS i, count(*) OVER (PARTITION BY w) AS m FROM s), "
    "w AS (SELECT w, count(*) AS n, CAST(sum(y_true) AS BIGINT) AS n_pos, sum(x) AS total, "
    + ", ".join(f"max(x) FILTER (WHERE i = ceil({q} * m / 100.0)) AS p{q}" for q in _QS) + " FROM o GROUP BY 1), "
    "grid AS (SELECT x FROM o, (SELECT unnest(range(1, 20)) AS q) WHERE w = (SELECT min(w) FROM s) AND i = ceil(5 * q * m / 100.0)), "
    "f AS (SELECT s.w, grid.x, avg(CASE WHEN s.x <= grid.x THEN 1.0 ELSE 0.0 END) AS r FROM s, (SELECT DISTINCT x FROM grid) grid GROUP BY 1, 2), "
    "g AS (SELECT f.w, max(abs(f.r - b.r)) AS gap FROM f JOIN f b ON b.x = f.x AND b.w = (SELECT min(w) FROM s) GROUP BY 1)"))
def q_score_drift_months(spark, sf_dir):
    """Scores per month from daily sketches: sum, quantiles, distance from the first month."""
    tx = transactions(spark, sf_dir)
    days = sd.daily_scores(heuristic_predictions(tx, keep=["trans_date_trans_time"]), score="y_pred_proba", label="y_true")
    # the mean of a few scores of 6 digits may end in half of the 6th digit, the sum can't
    return sd.score_drift(sd.merged(days, "month")).drop("mean_score")


# ---------------------------------------------------------------- more checks
@register("shape", with_views("SELECT count(*) AS n_rows, 22 AS n_columns FROM tx"))
def q_shape(spark, sf_dir):
    """Row and column counts of the raw transaction table."""
    tx = transactions(spark, sf_dir)
    return tx.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(tx.columns)))


@register("split_class_freq", with_views(
    f"SELECT split, is_fraud, count(*) AS n, {r6('count(*) / sum(count(*)) OVER (PARTITION BY split)')} AS freq "
    "FROM sp GROUP BY split, is_fraud", split_ctes()))
def q_split_class_freq(spark, sf_dir):
    """Label balance of each split (normalised value counts per split)."""
    sp = _split_feats(spark, sf_dir)
    c = sp.groupBy("split", "is_fraud").agg(F.count("*").alias("n")).checkpoint(eager=True)
    tot = c.groupBy("split").agg(F.sum("n").alias("_t"))  # from the small table, no second pass
    return c.join(F.broadcast(tot), "split").select("split", "is_fraud", "n", (F.col("n") / F.col("_t")).alias("freq"))


_FULL_UNPIVOT = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, is_fraud FROM feats" for c in _ENC_COLS)
_FULL_ENC = (f"pri AS (SELECT avg(is_fraud) AS prior FROM feats), "
             f"st AS (SELECT feature, value, count(*) AS n, avg(is_fraud) AS mean FROM ({_FULL_UNPIVOT}) u "
             "WHERE value IS NOT NULL GROUP BY 1, 2), "
             "enc AS (SELECT st.*, pri.prior, pri.prior * (1 - 1 / (1 + exp(-(n - 20.0) / 10.0))) "
             "+ mean * (1 / (1 + exp(-(n - 20.0) / 10.0))) AS enc FROM st, pri)")


@register("encode_full", with_views(
    "SELECT t.trans_num, " + ", ".join(f"{r6(f'coalesce(e_{c}.enc, (SELECT prior FROM pri))')} AS {c}" for c in _ENC_COLS)
    + " FROM feats t " + " ".join(
        f"LEFT JOIN (SELECT value, enc FROM enc WHERE feature = '{c}') e_{c} ON CAST(t.{c} AS VARCHAR) = e_{c}.value"
        for c in _ENC_COLS), _FULL_ENC))
def q_encode_full(spark, sf_dir):
    """Prediction-mode encoding: encoder refitted on all rows, then applied."""
    f = feats(spark, sf_dir).checkpoint(eager=True)
    return en.apply_target_encoder(f, en.fit_target_encoder(f)).select("trans_num", *_ENC_COLS)


_CAT_FEATS = ("fy AS (SELECT * FROM feats), fr AS (SELECT * FROM feats WHERE category IN ('1-URGENT', '2-HIGH')), "
              "fc AS (SELECT * FROM feats WHERE category NOT IN ('1-URGENT', '2-HIGH'))")
_STRONG_NUM = _DRIFT_NUM + ["is_fraud"]
_STRONG_CAT = [c for c in _DRIFT_CAT if c != "category"]


def _category_pair(spark, sf_dir):
    f = feats(spark, sf_dir)
    hi = F.col("category").isin("1-URGENT", "2-HIGH")
    return f.where(hi), f.where(~hi)


@register("drift_strong", with_views(_TABLE_BODY, _CAT_FEATS + ", " + drift_ctes(_STRONG_NUM, _STRONG_CAT, "fr", "fc")))
def q_drift_strong(spark, sf_dir):
    """Drift table for a strong shift: urgent/high-priority rows against the rest."""
    ref, cur = _category_pair(spark, sf_dir)
    return dr.drift_table(ref, cur, _STRONG_NUM + _STRONG_CAT)


_CHI_TESTS = {c: "chisquare" for c in _DRIFT_CAT}
_Z_TESTS = {c: "z" for c in _DRIFT_CAT}


@register("drift_chi2_stat", _drift_sql(f"SELECT column_name, {r6('stat')} AS stat, CAST(dof AS BIGINT) AS dof FROM chi",
                                        _CHI_TESTS))
def q_drift_chi2_stat(spark, sf_dir):
    """Chi-square goodness-of-fit statistic per text column (current vs scaled reference counts)."""
    ref, cur, vc = _vc(spark, sf_dir)
    return dr.chi2_statistics(vc, dr.choose_test(dr.column_summary(vc), _CHI_TESTS)).withColumn(
        "dof", F.col("dof").cast("long"))


@register("drift_z_stat", _drift_sql(f"SELECT column_name, {r6('stat')} AS stat FROM zt", _Z_TESTS))
def q_drift_z_stat(spark, sf_dir):
    """Two-proportion z statistic of each text column's smallest value."""
    ref, cur, vc = _vc(spark, sf_dir)
    return dr.z_statistics(vc, dr.choose_test(dr.column_summary(vc), _Z_TESTS))


# P(a, x) as the plain sum of its power series; enough terms for each row
_GAMMA_P = ("list_sum(list_transform(range(0, CAST(x + 20 * sqrt(x) + 100 AS BIGINT)), "
            "lambda n: exp((a + n) * ln(x) - x - lgamma(a + n + 1))))")
_P_TESTS = {c: "ks" for c in _DRIFT_NUM} | {c: "z" if c == "gender" else "chisquare" for c in _DRIFT_CAT}


@register("drift_p_values", _drift_sql(
    f"SELECT column_name, test, {r6('stat')} AS stat, {r6('CASE WHEN x <= 0 THEN 1 ELSE 1 - ' + _GAMMA_P + ' END')} AS p_value FROM ("
    "SELECT column_name, 'chisquare' AS test, stat, dof / 2.0 AS a, stat / 2 AS x FROM chi UNION ALL "
    "SELECT column_name, 'z', stat, 0.5, stat * stat / 2 FROM zt) g UNION ALL "
    f"SELECT column_name, 'ks', {r6('stat')}, {r6('CASE WHEN z < 0.2 THEN 1 ELSE least(1, greatest(0, 2 * list_sum(list_transform(range(1, 102), lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * j * j * z * z))))) END')} "
    "FROM (SELECT k.column_name, k.stat, sqrt(s.tot_ref * s.tot_cur / (s.tot_ref + s.tot_cur)) * k.stat AS z "
    "FROM ks k JOIN summ s USING (column_name)) h", _P_TESTS))
def q_drift_p_values(spark, sf_dir):
    """p-values of chi-square and z tests on text columns and of the KS statistic's limit law on numeric ones."""
    ref, cur, vc = _vc(spark, sf_dir)
    plan = dr.choose_test(dr.column_summary(vc), _P_TESTS).checkpoint(eager=True)
    return dr.p_values(vc, plan, exact_ks=False)


@register("drift_small_sample")
def q_drift_small_sample(spark, sf_dir):
    """p-value tests (KS for numeric, chi-square / Z for text) forced on every column."""
    ref, cur, vc = _vc(spark, sf_dir)
    tests = {c: "ks" for c in _DRIFT_NUM}
    tests.update({c: ("z" if c == "gender" else "chisquare") for c in _DRIFT_CAT})
    return dr.drift_table(ref, cur, _DRIFT_COLS, stattest=tests, vc=vc)


@register("encode_stream", ORACLE["encode_full"])
def q_encode_stream(spark, sf_dir):
    """Encoder fitted on the batch table, applied to the transaction stream."""
    f = feats(spark, sf_dir)
    enc = en.fit_target_encoder(f)
    root = _scratch(spark, "encode")
    out = st.encode_stream(st.features_stream(spark, sf_dir), enc).select("trans_num", *_ENC_COLS)
    st.run_available_now(out, f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@register("score_stream")
def q_score_stream(spark, sf_dir):
    """Model fitted on the encoded train split scores the encoded transaction stream."""
    raw = _split_feats(spark, sf_dir).where("split = 'train'").drop("split").checkpoint(eager=True)
    enc = en.fit_target_encoder(raw)  # the stream is encoded as the training rows were
    model = mo.fit_gbt(en.apply_target_encoder(raw, enc), fe.FEATURE_COLUMNS, preset="test")
    root = _scratch(spark, "score")
    scored = st.score_stream(st.encode_stream(st.features_stream(spark, sf_dir), enc), model)
    st.run_available_now(scored.select("trans_num", "is_fraud", "is_fraud_pred", "fraud_score"),
                         f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


# ---------------------------------------------------------------- sources round trips
@register("features_from_csv", ORACLE["features"])
def q_features_from_csv(spark, sf_dir):
    """Raw rows written as CSV with a pandas-style index column, read back with
    the pinned schema (index dropped, card number and zip as text), then featurised."""
    from riskframe.sources import io
    root = _scratch(spark, "csv")
    tx = transactions(spark, sf_dir)
    raw = tx.select(F.col("trans_num").cast("string").alias("Unnamed: 0"), *[
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "trans_date_trans_time" else F.col(c)
        for c in tx.columns])
    io.write_frame(raw, f"{root}/raw", fmt="csv")
    # the row key arrives as text in the raw schema; compare it as the source's integer key
    return fe.build_features(io.read_csv(spark, f"{root}/raw")).withColumn("trans_num", F.col("trans_num").cast("bigint"))


@register("versioned_roundtrip", ORACLE["encoder_apply"])
def q_versioned_roundtrip(spark, sf_dir):
    """Preprocess into a versioned dataset, then read the latest version's test split back."""
    from riskframe.plans.jobs import load_splits, run_preprocessing
    root = _scratch(spark, "versioned")
    run_preprocessing(spark, transactions(spark, sf_dir), root, version="20240101_000000")
    run_preprocessing(spark, transactions(spark, sf_dir), root, version="20240202_000000")
    _, test = load_splits(spark, root)  # latest
    return test.select("trans_num", *_ENC_COLS)


@register("version_commits", with_views(
    "SELECT '20240101_000000' AS version, split, count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_pos FROM sp GROUP BY split "
    "UNION ALL SELECT '20240202_000000', 'pred', count(*), CAST(sum(is_fraud) AS BIGINT) FROM feats", split_ctes()))
def q_version_commits(spark, sf_dir):
    """Two versions are written, one of them for prediction; the commit table tells their splits, rows and positives."""
    from riskframe.plans.jobs import run_preprocessing
    from riskframe.sources import io
    root = _scratch(spark, "commits")
    run_preprocessing(spark, transactions(spark, sf_dir), root, version="20240101_000000")
    run_preprocessing(spark, transactions(spark, sf_dir), root, for_prediction=True, version="20240202_000000")
    return io.commits(spark, f"{root}/datasets").select("version", "split", "n_rows", "n_pos")


@register("class_weight", with_views(
    "SELECT trans_num, is_fraud, CAST(CASE WHEN is_fraud = 1 THEN 10.0 ELSE 1.0 END AS DOUBLE) AS weight FROM feats"))
def q_class_weight(spark, sf_dir):
    """Per-row class weight (positives weighted 10)."""
    return fe.class_weight(feats(spark, sf_dir), 10.0).select("trans_num", "is_fraud", "weight")


_MODEL_ORDER = ["Unnamed: 0", "amt", "category", "merchant", "distance_km", "hour", "age", "cc_num"]


@register("align_features", with_views(
    f"SELECT {r6('amt')} AS amt, category, merchant, {r6('distance_km')} AS distance_km, hour, age, cc_num, trans_num FROM feats"))
def q_align_features(spark, sf_dir):
    """Features reordered to a model's list (extras dropped, the index column not re-created)."""
    return fe.align_features(feats(spark, sf_dir).withColumn("extra", F.lit(1)), _MODEL_ORDER, keep=["trans_num"])


@register("daily_fraud_stream", with_views(
    "SELECT CAST(date_trunc('day', trans_date_trans_time) AS DATE) AS day, CAST(sum(is_fraud) AS BIGINT) AS n_pos, "
    "count(*) AS n_rows FROM tx GROUP BY 1"))
def q_daily_fraud_stream(spark, sf_dir):
    """Watermarked daily positives over the transaction stream (days that have rows)."""
    root = _scratch(spark, "daily")
    st.run_updates_available_now(st.daily_label_counts(st.transactions_stream(spark, sf_dir)),
                                 f"{root}/changes", f"{root}/ckpt")
    return st.latest_state(spark.read.parquet(f"{root}/changes"), ["day"])


@register("daily_fraud_stream_filled", ORACLE["daily_fraud"])
def q_daily_fraud_stream_filled(spark, sf_dir):
    """The streamed daily positives with empty days as 0: the change log's last state, filled to a calendar."""
    root = _scratch(spark, "daily-filled")
    st.run_updates_available_now(st.daily_label_counts(st.transactions_stream(spark, sf_dir)), f"{root}/changes", f"{root}/ckpt")
    filled = pr.fill_days(st.latest_state(spark.read.parquet(f"{root}/changes"), ["day"]))
    return filled.select(*QUERIES["daily_fraud"](spark, sf_dir).columns)
