"""Columns of vectors as NumPy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def vectors_of(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each row's components in double precision; nothing for a missing vector or one with a missing or non-finite component."""
    sizes = [None if n is None else int(n) for n in pc.list_value_length(column).to_pylist()]
    flat = np.asarray(pc.list_flatten(column).to_numpy(zero_copy_only=False), np.float64)
    finite, start = np.isfinite(flat), 0
    for size in sizes:
        if size is None:
            yield None
            continue
        yield flat[start : start + size] if finite[start : start + size].all() else None
        start += size


def blob(vector: np.ndarray) -> bytes:
    """Bytes of a vector, in single precision where that is exact."""
    with np.errstate(over="ignore"):
        single = vector.astype("<f4")
    return single.tobytes() if (single.astype(np.float64) == vector).all() else vector.astype("<f8").tobytes()


def matrix(blobs: pa.ChunkedArray, size: int) -> np.ndarray:
    """Rows of vectors of one size, in double precision."""
    found = np.empty((len(blobs), size), np.float64)
    for row, value in zip(found, blobs):
        data = value.as_buffer()
        row[:] = np.frombuffer(data, "<f4" if data.size == 4 * size else "<f8") if size else 0
    return found


def units(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square runs over or under."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)
