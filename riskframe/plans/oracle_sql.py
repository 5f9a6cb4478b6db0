"""DuckDB text of the registered queries (the SQL oracle).

Built from shared fragments: the transaction view, the feature view, the
hash-ranked split.  Floats are rounded to 6 digits and integer types cast to
the Spark result types, so both engines produce the same rows and schema.
"""

from __future__ import annotations

from riskframe.sources.transactions import TRANSACTIONS_SQL

TS = "trans_date_trans_time"

FEATURES_SQL = f"""
SELECT trans_num, cc_num, merchant, category, ln(1 + amt) AS amt, gender, state, zip, city_pop, job,
  CAST(year({TS}) - year(dob) AS INTEGER) AS age,
  CAST(hour({TS}) AS INTEGER) AS hour,
  CAST(isodow({TS}) - 1 AS INTEGER) AS dayofweek,
  CAST(month({TS}) AS INTEGER) AS month,
  2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a)) AS distance_km,
  is_fraud
FROM (SELECT *, pow(sin(radians(merch_lat - lat) / 2), 2)
        + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin(radians(merch_long - long) / 2), 2) AS a
      FROM tx) t
"""


def with_views(body: str, extra: str = "") -> str:
    """Prefix the transaction and feature CTEs to a query body."""
    ctes = f"WITH tx AS ({TRANSACTIONS_SQL}), feats AS ({FEATURES_SQL})"
    if extra:
        ctes += ", " + extra
    return f"{ctes}\n{body}"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


def md5_key(key: str, seed: int = 42) -> str:
    return f"md5(concat(CAST({key} AS VARCHAR), '-{seed}'))"


def quota_cte(name: str, src: str, held_out: str, label: str = "is_fraud") -> str:
    """CTE ``name(label, quota)``: held-out rows per class, largest-remainder
    allocation of the kept side (``held_out`` is SQL for the held-out total
    given ``N``)."""
    return (
        f"{name}_c AS (SELECT {label}, count(*) AS n FROM {src} GROUP BY 1), "
        f"{name}_t AS (SELECT sum(n) AS N, sum(n) - ({held_out}) AS n_keep FROM {name}_c), "
        f"{name}_a AS (SELECT c.{label}, c.n, CAST(c.n AS DOUBLE) * t.n_keep / t.N AS cont, t.n_keep "
        f"FROM {name}_c c, {name}_t t), "
        f"{name}_b AS (SELECT {label}, n, floor(cont) AS fl, cont - floor(cont) AS rem, "
        f"n_keep - sum(floor(cont)) OVER () AS need FROM {name}_a), "
        f"{name} AS (SELECT {label}, CAST(n - fl - CASE WHEN row_number() OVER (ORDER BY rem DESC, {label}) <= need "
        f"THEN 1 ELSE 0 END AS BIGINT) AS quota FROM {name}_b)")


def split_ctes(test_size: float = 0.2, seed: int = 42) -> str:
    """``q`` quotas and ``sp``: features with split in {'train','test'}."""
    held = f"CAST(ceil(CAST({test_size} AS DOUBLE) * sum(n)) AS BIGINT)"
    return (quota_cte("q", "feats", held) + ", "
            f"sp AS (SELECT f.*, CASE WHEN row_number() OVER (PARTITION BY f.is_fraud ORDER BY "
            f"{md5_key('f.trans_num', seed)}, f.trans_num) <= q.quota THEN 'test' ELSE 'train' END AS split "
            f"FROM feats f JOIN q USING (is_fraud))")


# Deterministic scorer used to build a pre-computed prediction table.
SCORE_SQL = ("round(1.0 / (1.0 + exp(-(ln(1 + amt) - 12.5) * 3.0)) * "
             "CASE WHEN category = '1-URGENT' THEN 1.0 ELSE 0.5 END, 6)")
PRED_CTE = (f"pred AS (SELECT trans_num, is_fraud AS y_true, {SCORE_SQL} AS y_pred_proba FROM tx), "
            "preds AS (SELECT trans_num, y_true, y_pred_proba, "
            "CAST(CASE WHEN y_pred_proba >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS y_pred_binary FROM pred)")


def drift_ctes(num_cols: list[str], cat_cols: list[str], ref: str, cur: str, stattest: str | dict | None = None) -> str:
    """CTEs ``vc`` (value counts), ``summ`` (per-column summary + chosen test),
    ``wd`` (normed Wasserstein), ``js`` (Jensen-Shannon), ``ks`` (KS statistic)."""
    parts = []
    for side, src in ((1, ref), (0, cur)):
        for c in num_cols:
            parts.append(f"SELECT {side} AS r, '{c}' AS column_name, 'num' AS kind, CAST({c} AS DOUBLE) AS num, "
                         f"CAST(NULL AS VARCHAR) AS cat FROM {src}")
        for c in cat_cols:
            parts.append(f"SELECT {side} AS r, '{c}' AS column_name, 'cat' AS kind, CAST(NULL AS DOUBLE) AS num, "
                         f"CAST({c} AS VARCHAR) AS cat FROM {src}")
    auto = ("CASE WHEN kind = 'num' THEN (CASE WHEN n_distinct <= 5 THEN (CASE WHEN tot_ref > 1000 THEN 'jensenshannon' "
            "WHEN n_distinct > 2 THEN 'chisquare' ELSE 'z' END) ELSE (CASE WHEN tot_ref > 1000 THEN 'wasserstein' "
            "ELSE 'ks' END) END) ELSE (CASE WHEN tot_ref > 1000 THEN 'jensenshannon' WHEN n_distinct > 2 THEN 'chisquare' "
            "ELSE 'z' END) END")
    if isinstance(stattest, str):
        test = f"'{stattest}'"
    elif stattest:
        test = "CASE column_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in stattest.items()) + f" ELSE {auto} END"
    else:
        test = auto
    return (
        f"lng AS ({' UNION ALL '.join(parts)}), "
        "vc AS (SELECT column_name, kind, num, cat, CAST(sum(r) AS BIGINT) AS n_ref, CAST(sum(1 - r) AS BIGINT) AS n_cur "
        "FROM lng WHERE num IS NOT NULL OR cat IS NOT NULL GROUP BY 1, 2, 3, 4), "
        "s0 AS (SELECT column_name, kind, sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur, count(*) AS n_distinct, "
        "min(num) AS lo, max(num) AS hi, sum(num * n_ref) / sum(n_ref) AS mean_ref FROM vc GROUP BY 1, 2), "
        "s1 AS (SELECT column_name, sqrt(sum(n_ref * pow(num - mean_ref, 2)) / sum(n_ref)) AS std_ref "
        "FROM vc JOIN s0 USING (column_name) GROUP BY 1), "
        f"summ AS (SELECT s0.*, s1.std_ref, {test} AS test FROM s0 JOIN s1 USING (column_name)), "
        "cdf AS (SELECT v.column_name, v.num, abs(sum(v.n_ref) OVER w / s.tot_ref - sum(v.n_cur) OVER w / s.tot_cur) AS gap, "
        "lead(v.num) OVER w AS nxt, s.test, s.std_ref FROM vc v JOIN summ s USING (column_name) WHERE v.kind = 'num' "
        "WINDOW w AS (PARTITION BY v.column_name ORDER BY v.num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), "
        "wd AS (SELECT column_name, sum(gap * (nxt - num)) / greatest(max(std_ref), 0.001) AS score FROM cdf "
        "WHERE test = 'wasserstein' GROUP BY 1), "
        "ks AS (SELECT column_name, max(gap) AS stat FROM cdf WHERE test = 'ks' GROUP BY 1), "
        "jk AS (SELECT v.column_name, CASE WHEN v.kind = 'num' AND s.n_distinct <= 5 THEN CAST(v.num AS VARCHAR) WHEN v.kind = 'num' THEN CAST(CASE WHEN s.hi = s.lo THEN 15 ELSE "
        "least(floor((v.num - s.lo) / (s.hi - s.lo) * 30), 29) END AS VARCHAR) ELSE v.cat END AS key, "
        "sum(v.n_ref) / max(s.tot_ref) AS p, sum(v.n_cur) / max(s.tot_cur) AS q FROM vc v JOIN summ s USING (column_name) "
        "WHERE s.test = 'jensenshannon' GROUP BY 1, 2), "
        "js AS (SELECT column_name, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END "
        "+ CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS score FROM jk GROUP BY 1), "
        "chi AS (SELECT v.column_name, sum(CASE WHEN v.n_ref = 0 THEN (CASE WHEN v.n_cur > 0 THEN 'inf'::DOUBLE ELSE 0 END) "
        "ELSE pow(v.n_cur - v.n_ref * (s.tot_cur / s.tot_ref), 2) / (v.n_ref * (s.tot_cur / s.tot_ref)) END) AS stat, "
        "max(s.n_distinct) - 1 AS dof FROM vc v JOIN summ s USING (column_name) WHERE s.test = 'chisquare' GROUP BY 1), "
        "zt AS (SELECT column_name, CASE WHEN n_distinct = 1 THEN 0.0 ELSE (a / tot_ref - b / tot_cur) / sqrt(((a + b) / (tot_ref + tot_cur)) "
        "* (1 - (a + b) / (tot_ref + tot_cur)) * (1 / tot_ref + 1 / tot_cur)) END AS stat FROM (SELECT s.column_name, s.n_distinct, "
        "s.tot_ref, s.tot_cur, arg_min(v.n_ref, coalesce(v.num, 0)) FILTER (WHERE v.kind = 'num') AS an, "
        "arg_min(v.n_cur, coalesce(v.num, 0)) FILTER (WHERE v.kind = 'num') AS bn, arg_min(v.n_ref, v.cat) FILTER (WHERE v.kind = 'cat') AS ac, "
        "arg_min(v.n_cur, v.cat) FILTER (WHERE v.kind = 'cat') AS bc, coalesce(an, ac) AS a, coalesce(bn, bc) AS b "
        "FROM vc v JOIN summ s USING (column_name) WHERE s.test = 'z' GROUP BY 1, 2, 3, 4) zz)")
