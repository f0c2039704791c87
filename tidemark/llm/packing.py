"""Whole numbers packed into bytes that compress well: all first bytes, then all second bytes, and so on."""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray, kind: type) -> bytes:
    raw = np.ascontiguousarray(values, kind)
    return raw.view(np.uint8).reshape(len(raw), -1).T.tobytes() if len(raw) else b""


def unpack(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit values as their differences, whose upper bytes are mostly zero."""
    return pack(np.diff(values, prepend=np.uint64(0)), np.uint64)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)
