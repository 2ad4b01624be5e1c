"""Vectors of whole numbers, on which distances and products are exact."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Below this, whole numbers are exact in doubles.
EXACT = 2**53


def finite(vector: str) -> Column:
    """Whether the vector is not null and has only finite components; never null."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & fits, F.lit(False))


def widest(size: int, bits: int) -> int:
    """The largest component for which sums of ``size`` products stay below ``2**bits``."""
    return min(2**30, math.isqrt((1 << bits) // max(1, size)))


def whole(vector: str, scale: int) -> Column:
    """``floor(scale * x)`` of each component, taken as a double; only for components that fit."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))


def within(vector: str, scale: int, limit: int) -> Column:
    """Whether all components scale to at most ``limit``, so that ``whole`` can hold them."""
    return F.forall(vector, lambda x: F.abs(x.cast("double") * scale) < float(limit))


def matrix(column: pa.Array | pa.ChunkedArray, size: int, exact_in_doubles: bool) -> np.ndarray:
    """One row for each list of ``size`` integers; in doubles if these stay exact."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64 if exact_in_doubles else np.int64).reshape(-1, size)
