"""Number arrays as small binary values, for tables whose rows stand for many documents."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes each as the largest needs, the bytes by place, compressed."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    planes = np.ascontiguousarray(values.astype(f"<u{width}")).view("u1").reshape(-1, width).T
    body = pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True) if len(values) else b""
    return bytes([width]) + len(values).to_bytes(8, "little") + body


def unpack(raw: bytes) -> np.ndarray:
    """The numbers again, as 64-bit integers."""
    width, n = raw[0], int.from_bytes(raw[1:9], "little")
    if not n:
        return np.zeros(0, dtype="int64")
    planes = np.frombuffer(pa.decompress(raw[9:], width * n, codec="zstd", asbytes=True), dtype="u1").reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype("int64")


def pack_ids(values: list[int | None]) -> bytes:
    """64-bit integers or nulls."""
    here = np.array([value is not None for value in values], dtype="u1")
    return here.tobytes() + np.array([value or 0 for value in values], dtype="<i8").tobytes()


def unpack_ids(raw: bytes) -> pd.api.extensions.ExtensionArray:
    n = len(raw) // 9
    return pd.arrays.IntegerArray(np.frombuffer(raw, dtype="<i8", offset=n).astype("int64"), np.frombuffer(raw, dtype="u1", count=n) == 0)
