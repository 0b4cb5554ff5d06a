"""Number arrays as compact bytes, for rows that carry many entries through a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Differences of a 64-bit array, split into byte planes and compressed: slowly growing numbers take
    about one byte each."""
    steps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    steps = (steps << 1) ^ (steps >> 63)
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    count = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], 8 * count, codec="zstd", asbytes=True)
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, count).T).view(np.uint64).ravel()
    # Shifted without the sign, so that differences of any size come back.
    return np.cumsum((steps >> np.uint64(1)).view(np.int64) ^ -(steps & np.uint64(1)).view(np.int64))


def pack_even(values: np.ndarray) -> bytes:
    """An array of numbers in no order: byte planes, compressed, so that only the bytes in use take room."""
    size = values.dtype.itemsize
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, size).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack_even(data: bytes, kind: type) -> np.ndarray:
    count, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], count * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, count).T).view(kind).ravel()
