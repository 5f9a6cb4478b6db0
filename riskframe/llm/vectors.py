"""Vectors of whole numbers in Arrow tables: rows of (id, v, ...) to numpy matrices, exact arithmetic.

Whole-numbered components are exact in doubles and in 64-bit integers while
products and sums stay below 2^53; beyond that Python's unbounded integers take
over, so results are exact at any size of the components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = 1 << 53
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def finite(embedding: str) -> Column:
    """Whether a vector is not null and none of its components is null or non-finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(embedding).isNotNull() & ~F.coalesce(bad, F.lit(False))


def floored(embedding: str, scale: float) -> Column:
    """floor(scale * x) of each component as doubles (Spark's own floor gives a long, which cuts large values)."""
    def one(x: Column) -> Column:
        y = x.cast("double") * F.lit(scale)
        whole = F.rint(y)
        return F.when(whole > y, whole - 1).otherwise(whole)
    return F.transform(embedding, one)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all components, length of each vector) of a column of arrays without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors of a column of arrays, all of ``width`` components, as doubles."""
    return flat(column)[0].astype(np.float64, copy=False).reshape(-1, width)


def unbounded(x: np.ndarray) -> np.ndarray:
    """Whole-numbered doubles as an array of Python integers."""
    out = np.empty(x.shape, object)
    out.ravel()[:] = [int(v) for v in x.ravel()]
    return out


def as_long(x) -> int:
    """An exact integer, cut to the range of a long."""
    return min(max(int(x), LOW), HIGH)
