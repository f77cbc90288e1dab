"""Vectors as columns: which take part, exact copies as classes, Arrow to numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not empty, all components finite, not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def as_double(df: DataFrame, vec_col: str) -> Column:
    return F.col(f"`{vec_col}`").cast("array<double>")


def matrix(col: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))
