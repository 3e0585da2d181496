"""Arrays of numbers as compressed bytes, for rows that carry a batch's worth of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_HEAD = 9  # bytes before the compressed part: item size, number of items


def pack(a: np.ndarray, level: int = 1) -> bytes:
    """The numbers of ``a`` with the bytes of equal weight side by side, which compresses small numbers well."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else np.zeros(0, np.uint8)
    body = pa.Codec("zstd", compression_level=level).compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)
    return bytes([a.itemsize]) + len(a).to_bytes(8, "little") + body


def unpack(raw: bytes, kind=np.int64) -> np.ndarray:
    """The packed numbers as an array of ``kind``, whose item size is the packed one."""
    size, n = raw[0], int.from_bytes(raw[1:_HEAD], "little")
    if n == 0:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.Codec("zstd").decompress(raw[_HEAD:], n * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).reshape(-1).view(kind)


def pack_sorted(a: np.ndarray) -> bytes:
    """As ``pack``, by differences: ``a`` holds ascending unsigned numbers."""
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(raw: bytes, kind=np.uint64) -> np.ndarray:
    return np.cumsum(unpack(raw, kind), dtype=kind)
