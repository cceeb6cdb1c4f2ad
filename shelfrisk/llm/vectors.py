"""Vectors as packed binaries inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & ~bad, F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of doubles; shorter vectors end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def packed(rows: np.ndarray) -> pa.Array:
    """One binary per row."""
    rows = np.ascontiguousarray(rows)
    size = rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(size), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())

