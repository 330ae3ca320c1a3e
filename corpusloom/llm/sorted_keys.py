"""Sorted integers and counts as small binary values."""

import zlib

import numpy as np


def pack(keys: np.ndarray) -> bytes:
    """Ascending unsigned integers as compressed differences, low bytes before high ones."""
    size = keys.dtype.itemsize
    steps = np.diff(keys, prepend=keys[:1] * keys.dtype.type(0))
    return zlib.compress(steps.view(np.uint8).reshape(-1, size).T.tobytes(), 1)


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    steps = np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(kind).ravel(), dtype=kind)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Any integers, unsigned, of up to 64 bits."""
    return zlib.compress(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T
    return np.ascontiguousarray(planes).view("<u8").ravel()
