"""Helpers for Arrow kernels that work on array columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as an n x d matrix of doubles; null elements become NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    n = len(column)
    if n and flat.size % n:
        raise ValueError("all vectors of a batch must have the same length")
    return flat.reshape(n, -1)


def stacked(column: pa.Array) -> np.ndarray:
    """A list-of-lists column as an n x k x d tensor."""
    n = len(column)
    inner = column.flatten()
    k = len(inner) // n if n else 0
    return matrix(inner).reshape(n, k, -1)


def lists(values: np.ndarray) -> pa.Array:
    """An n x d matrix as a list column."""
    n, d = values.shape
    offsets = np.arange(0, (n + 1) * d, d, dtype=np.int32) if d else np.zeros(n + 1, np.int32)
    flat = pa.array(np.ascontiguousarray(values).reshape(-1))
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def chunks(batch: pa.RecordBatch, rows: int = 1024):
    """Slices of a batch, so that temporaries stay small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
