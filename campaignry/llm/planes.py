"""Byte planes of integer arrays: the high bytes of near values stand together, so that they compress well."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(*columns: np.ndarray) -> bytes:
    """Equally long arrays, one after the other, each by byte planes, compressed; the number of raw bytes goes first."""
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns if len(c))
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    """The arrays of these types, as long as the bytes tell."""
    raw = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), np.uint8)
    n, at, out = len(raw) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for k in map(np.dtype, kinds):
        size = n * k.itemsize
        out.append(np.ascontiguousarray(raw[at: at + size].reshape(k.itemsize, n).T).reshape(-1).view(k))
        at += size
    return out
