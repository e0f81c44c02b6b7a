"""Fixed-width values in Arrow binary columns, as arrays that share their memory."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def rows_of(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    """(n x width) values out of a binary column whose values all have the same size and none of which is null."""
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    first, last = offsets[column.offset], offsets[column.offset + len(column)]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8, last - first, first).view(dtype).reshape(-1, width) if last > first else np.zeros((0, width), dtype)


def column_of(rows: np.ndarray) -> pa.Array:
    """A binary column of the rows of an array."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])
