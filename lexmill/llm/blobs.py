"""Compact messages between chunks of documents and ranges of a hash space.

A task that holds a chunk of documents asks the tasks that hold the ranges of the hash
space about its hashes.  It sends one message per range, whatever the number of hashes, so
a hash that a third of all documents share is sent once a chunk; the answer is a bit for
each hash of the message, in its order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_ZSTD = pa.Codec("zstd", compression_level=1)
U64 = np.uint64


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each hash, in the order of the hashes' upper 48 bits; at most 65,536 ranges."""
    return (((hashes >> U64(16)) * U64(ranges)) >> U64(48)).astype(np.int64)


def short_code(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """32 bits that follow those which tell the range; they grow with the hash inside a range."""
    return (((hashes >> U64(16)) * U64(ranges)) >> U64(16)).astype(np.uint32)


def pack(values: np.ndarray) -> bytes:
    """Ascending (or any) unsigned integers as compressed planes of the bytes of their differences."""
    deltas = np.diff(values, prepend=values[:1] * 0)
    return pack_plain(deltas)


def unpack(data: bytes, n: int, dtype: type) -> np.ndarray:
    return np.cumsum(unpack_plain(data, n, dtype), dtype=dtype)


def pack_plain(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return _ZSTD.compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def unpack_plain(data: bytes, n: int, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(_ZSTD.decompress(data, decompressed_size=n * size, asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(dtype).reshape(n)


def pack_bits(bits: np.ndarray) -> bytes:
    return _ZSTD.compress(np.packbits(bits).tobytes(), asbytes=True)


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    raw = _ZSTD.decompress(data, decompressed_size=(n + 7) // 8, asbytes=True) if n else b""
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Whether each value is among the ascending ones."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values
