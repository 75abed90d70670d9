"""Vectors of an Arrow list column as a matrix, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def sound_rows(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``lengths, owner, values`` of a list column.

    ``lengths`` has every row's length, -1 if the vector is null or holds a null or
    non-finite entry; ``values`` has the entries of all other rows as doubles, ``owner`` their rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null becomes NaN
    owner = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
    lengths[owner[~np.isfinite(values)]] = -1
    whole = lengths[owner] >= 0
    return lengths, owner[whole], values[whole]


def scaled(values: np.ndarray, by: int, most: int) -> np.ndarray:
    """``floor(by * value)`` as whole numbers. One beyond ``most`` is an error: the sums could not be exact."""
    out = np.floor(by * values)
    if len(out) and np.abs(out).max() > most:
        raise ValueError(f"a vector's entry is beyond {most / by:g}")
    return out.astype(np.int64)
