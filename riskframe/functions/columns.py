"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km (atan2 form, R = 6371)."""
    lat1, lon1, lat2, lon2 = map(col_, (lat1, lon1, lat2, lon2))
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    d_phi = F.radians(lat2 - lat1)
    d_lam = F.radians(lon2 - lon1)
    a = F.pow(F.sin(d_phi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(d_lam / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def weekday_mon0(ts) -> Column:
    """Day of week with Monday = 0 (pandas ``dt.dayofweek``)."""
    return F.weekday(col_(ts))


def age_years(ts, dob) -> Column:
    """Calendar-year difference, not birthday exact."""
    return F.year(col_(ts)) - F.year(col_(dob))


def key_text(key) -> Column:
    """A row key as text; a list of columns is joined with '|' (composite key)."""
    if isinstance(key, (list, tuple)):
        return F.concat_ws("|", *[col_(k).cast("string") for k in key])
    return col_(key).cast("string")


def rank_hash(key, seed: int) -> Column:
    """Reproducible pseudo-random order key: md5 of ``key || '-' || seed``.

    The same text hashes identically in DuckDB, so sample membership is
    checkable against the SQL oracle.
    """
    return F.md5(F.concat(key_text(key), F.lit(f"-{seed}")))


def hash_unit(key, seed: int) -> Column:
    """Uniform draw in [0, 1) from the first 13 hex digits of ``rank_hash``."""
    h = F.conv(F.substring(rank_hash(key, seed), 1, 13), 16, 10).cast("double")
    return h / F.lit(float(16 ** 13))


def round_floats(df, digits: int = 6):
    """Round every float/double column (used only when presenting results)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        out.append(F.round(F.col(f.name), digits).alias(f.name) if t in ("double", "float") else F.col(f.name))
    return df.select(*out)
