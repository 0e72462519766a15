"""Text columns of Arrow batches as byte arrays, without Python strings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the row offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
                         else pa.large_string()).fill_null("" if not pa.types.is_large_binary(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def row_groups(offsets: np.ndarray, most_bytes: int):
    """Runs [a, b) of rows with about ``most_bytes`` each; a longer row stands alone."""
    a = 0
    while a < len(offsets) - 1:
        b = int(np.searchsorted(offsets, offsets[a] + most_bytes, "right")) - 1
        b = max(b, a + 1)
        yield a, b
        a = b
