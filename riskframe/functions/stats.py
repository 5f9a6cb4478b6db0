"""p-values of the drift tests, as Column expressions over one-row-per-column summary tables.

The chi-square and normal tails are regularised incomplete gamma functions,
summed with ``aggregate`` over a sequence of as many terms as a row needs.
Only the exact Kolmogorov-Smirnov probability, a recursion over lattice paths,
is numpy in a pandas UDF; it sees a row per tested column, never data rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

NORMAL_DOF = 1e6  # beyond it the gamma function's rounding is larger than the normal law's error
EXACT_KS_ROWS = 10_000  # up to this many rows on the larger side the KS probability is exact (scipy's rule)
TINY = 1e-300
NAN = float("nan")


def _terms(a: Column) -> Column:
    """1 .. as many terms as the sums below need for a shape ``a``: neighbours shrink like a normal law of variance a."""
    return F.sequence(F.lit(1), (F.lit(80) + F.ceil(F.lit(10.0) * F.sqrt(a))).cast("int"))


def lgamma(a: Column) -> Column:
    """ln of the gamma function for a > 0, by Stirling's series ten places further up."""
    z = a + 10.0
    inverse = F.lit(1.0) / z
    square = inverse * inverse
    series = inverse * (F.lit(1 / 12) - square * (F.lit(1 / 360) - square * (F.lit(1 / 1260) - square * (F.lit(1 / 1680) - square / 1188))))
    shift = sum((F.log(a + float(i)) for i in range(1, 10)), F.log(a))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shift


def gamma_q(a: Column, x: Column) -> Column:
    """Upper regularised incomplete gamma function Q(a, x): a power series below a + 1, a continued fraction above."""
    scale = F.exp(a * F.log(x) - x - lgamma(a))
    series = F.aggregate(_terms(a), F.struct((F.lit(1.0) / a).alias("term"), (F.lit(1.0) / a).alias("total")), lambda s, n: F.struct(
        (s["term"] * x / (a + n)).alias("term"), (s["total"] + s["term"] * x / (a + n)).alias("total")), lambda s: s["total"])
    clear = lambda v: F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)

    def step(s: Column, n: Column) -> Column:
        an = -n * (n - a)
        b = x + 2.0 * n + 1.0 - a
        c, d = clear(b + an / s["c"]), F.lit(1.0) / clear(b + an * s["d"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    first = F.lit(1.0) / clear(x + 1.0 - a)
    start = F.struct(F.lit(1 / TINY).alias("c"), first.alias("d"), first.alias("h"))
    fraction = F.aggregate(F.transform(_terms(a), lambda n: n.cast("double")), start, step, lambda s: s["h"])
    q = F.when(x < a + 1.0, F.lit(1.0) - scale * series).otherwise(scale * fraction)
    return F.when(x <= 0, F.lit(1.0)).when(x == float("inf"), F.lit(0.0)).otherwise(F.greatest(F.least(q, F.lit(1.0)), F.lit(0.0)))


def norm_two_sided_p(z: Column) -> Column:
    """P(|Z| >= |z|) of a standard normal Z: Q(1/2, z^2 / 2); NaN without a statistic."""
    return F.when(z.isNull() | F.isnan(z), F.lit(NAN)).otherwise(gamma_q(F.lit(0.5), z * z / 2.0))


def chi2_sf(stat: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution: Q(dof / 2, stat / 2); beyond ``NORMAL_DOF`` the cube root is
    normal (Wilson and Hilferty), with an error of the order of 1 / dof."""
    dof = dof.cast("double")
    spread = F.lit(2.0) / (F.lit(9.0) * dof)
    z = (F.pow(stat / dof, F.lit(1 / 3)) - (F.lit(1.0) - spread)) / F.sqrt(spread)
    half = norm_two_sided_p(z) / 2.0
    normal = F.when(z >= 0, half).otherwise(F.lit(1.0) - half)
    exact = gamma_q(F.least(dof, F.lit(NORMAL_DOF)) / 2.0, stat / 2.0)
    return F.when(stat.isNull() | F.isnan(stat) | dof.isNull() | (dof <= 0), F.lit(NAN)).when(dof > NORMAL_DOF, normal).otherwise(exact)


def kolmogorov_sf(z: Column) -> Column:
    """Asymptotic Kolmogorov tail P(K > z) = 2 sum (-1)^(j-1) exp(-2 j^2 z^2); 1 where it is to all digits."""
    total = F.aggregate(F.sequence(F.lit(1), F.lit(101)), F.lit(0.0), lambda s, j: s + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(
        F.lit(-2.0) * j * j * z * z))
    return F.when(z < 0.2, F.lit(1.0)).otherwise(F.greatest(F.least(2.0 * total, F.lit(1.0)), F.lit(0.0)))


def ks_exact_p(d: float, n1: int, n2: int) -> float:
    """Exact two-sided P(D >= d) for two samples of sizes n1, n2 (no ties): the
    share of lattice paths from (0, 0) to (n1, n2) that leave the band
    |i/n1 - j/n2| < d.  Row i of the path counts is a running sum over the
    places of row i - 1 that lie in the band, kept as a share of all paths."""
    m, n = max(int(n1), int(n2)), min(int(n1), int(n2))
    j = np.arange(n + 1)
    tol = 1e-12
    paths = (np.abs(j / n) < d - tol).cumprod().astype(float)  # one path along the edge, while inside
    log_scale = 0.0
    for i in range(1, m + 1):
        inside = np.abs(i / m - j / n) < d - tol
        paths = np.where(inside, paths, 0.0)
        low = int(inside.argmax()) if inside.any() else 0
        paths = np.where(inside, np.cumsum(np.where(j >= low, paths, 0.0)), 0.0)
        top = paths.max()
        if top == 0:
            return 1.0
        if top > 1e100:
            paths, log_scale = paths / top, log_scale + math.log(top)
    if paths[n] <= 0:
        return 1.0
    log_all = math.lgamma(m + n + 1) - math.lgamma(m + 1) - math.lgamma(n + 1)
    return max(0.0, min(1.0, -math.expm1(math.log(paths[n]) + log_scale - log_all)))


@F.pandas_udf(DoubleType())
def ks_exact(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([NAN if pd.isna(x) else ks_exact_p(float(x), int(a), int(b)) for x, a, b in zip(d, n1, n2)], dtype="float64")


def ks_p_value(d: Column, n1: Column, n2: Column, exact: bool = True) -> Column:
    """Two-sided p-value of a KS statistic: exact up to ``EXACT_KS_ROWS`` rows a side unless told otherwise."""
    known = d.isNotNull() & ~F.isnan(d) & (n1 > 0) & (n2 > 0)
    limit = kolmogorov_sf(F.sqrt(n1 * (n2 / F.greatest(n1 + n2, F.lit(1)))) * d)
    if not exact:
        return F.when(known, limit).otherwise(NAN)
    small = known & (F.greatest(n1, n2) <= EXACT_KS_ROWS)
    # the recursion only gets the rows it is for
    return F.when(small, ks_exact(F.when(small, d), n1, n2)).when(known, limit).otherwise(NAN)
