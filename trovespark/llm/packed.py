"""Arrays of numbers as compressed bytes, for what tasks tell each other."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """An array as bytes: its bytes by place, compressed. Counts and places mostly have empty high bytes."""
    plain = np.ascontiguousarray(values)
    planes = plain.view(np.uint8).reshape(-1, plain.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpack(raw: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    planes = pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    item = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(item, -1).T).view(kind).reshape(-1)
