"""Vectors of Arrow batches as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrices(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of the vectors of a list column, shortest first.

    Vectors that are null, empty or hold null or non-finite components are in none.
    """
    if not len(column):
        return []
    offsets = np.asarray(column.offsets, dtype=np.int64)
    flat = pc.fill_null(column.values.cast(pa.float64()), float("nan"))
    flat = np.asarray(flat, dtype=np.float64)
    size = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
    out = []
    for n in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == n)
        rows = flat[offsets[at][:, None] + np.arange(n)]
        fine = np.isfinite(rows).all(axis=1)
        if fine.any():
            out.append((at[fine], rows[fine]))
    return out


def scaled(rows: np.ndarray, by: float, most: int) -> np.ndarray:
    """floor(by * x) as integers; what lies beyond +-``most`` is held there."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(rows * by), -float(most), float(most)).astype(np.int64)
