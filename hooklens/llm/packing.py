"""Numpy arrays as binary columns.

A column of random 64-bit values costs its full width in a shuffle. Sorted and laid out byte plane by
byte plane, its high planes are runs, which the shuffle's own compression removes.
"""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray) -> bytes:
    """Byte planes of an integer array, most even ones last."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, dtype=np.uint8).reshape(size, len(data) // size)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans_of(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(key, start, end) of the runs of a sorted array."""
    if not len(keys):
        return []
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return list(zip(keys[starts].tolist(), starts.tolist(), np.append(starts[1:], len(keys)).tolist()))
