"""Vectors in tasks: list columns to matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether the vector and all its components are there and finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers; shorter lists are filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def width_of(*columns: pa.ChunkedArray) -> int:
    return max((int(n) for c in columns for x in c.chunks if len(x) for n in [x.value_lengths().to_numpy(zero_copy_only=False).max()]), default=0)
