"""Arrow string columns as flat numpy code-point arrays, and back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def flat_strings(arr: pa.Array) -> pa.StringArray:
    """A contiguous 32-bit-offset string array."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not pa.types.is_string(arr.type):
        arr = arr.cast(pa.string())
    return arr


def to_codepoints(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all rows, row offsets into them); null rows are empty."""
    arr = flat_strings(arr)
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    if arr.null_count:
        arr = arr.fill_null("")
    _, off_buf, data_buf = arr.buffers()
    offsets = np.frombuffer(off_buf, np.int32, n + 1, arr.offset * 4).astype(np.int64)
    raw = b"" if data_buf is None else data_buf.to_pybytes()[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    try:
        codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "<u4")
    except UnicodeDecodeError:  # bytes that are no UTF-8: row by row, so that offsets stay right
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        return codes, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    starts = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    return codes, np.concatenate([[0], np.cumsum(starts, dtype=np.int64)])[offsets]


def from_codepoints(codes: np.ndarray, offsets: np.ndarray, nulls: np.ndarray | None = None) -> pa.Array:
    """The string array of code points and row offsets; `nulls` marks rows that become null."""
    codes = codes.astype("<u4", copy=False)
    size = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    ends = np.concatenate([[0], np.cumsum(size)])[offsets]
    data = codes.tobytes().decode("utf-32-le").encode("utf-8")
    validity = None
    if nulls is not None and nulls.any():
        validity = pa.py_buffer(np.packbits(~nulls, bitorder="little").tobytes())
    if len(data) >= 2**31:
        large = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data), validity)
        return large
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data), validity)


def null_mask(arr: pa.Array) -> np.ndarray:
    return np.asarray(arr.is_null())
