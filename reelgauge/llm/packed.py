"""Hashes of word sequences, and many of them packed into few rows for a shuffle.

A row per hash costs a shuffle some 20 bytes. Here a task sorts the distinct hashes of its batch by
part, a number got from the hash, and sends one row per part that holds them byte by byte.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import types as T

MIX = np.uint64(0xFF51AFD7ED558CCD)
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

SENT = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("unit", T.LongType()),
    T.StructField("blob", T.BinaryType()),
])


def word_hashes(texts: list[list[bytes]], total: int) -> np.ndarray:
    """A 64-bit hash of each word of some texts, one after the other."""
    return np.fromiter(
        map(xxhash.xxh3_64_intdigest, chain.from_iterable(texts)), np.uint64, total
    )


def mixed(values: np.ndarray) -> np.ndarray:
    out = values ^ (values >> np.uint64(32))
    out *= MIX
    out ^= out >> np.uint64(29)
    return out


def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    if size:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def rolling(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` words from each place on."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(inverse, n), out=sums[1:])
    out = (sums[size:] - sums[:-size]) * powers(base, n - size + 1)
    return mixed(out)


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest bytes first, so that the even high ones compress."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(data, np.uint8).reshape(size, -1).T
    return np.ascontiguousarray(flat).view(kind).reshape(-1)


def bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).view(bool)


def slices(part: np.ndarray):
    """The parts that occur in a sorted column, with their first and last place."""
    if len(part):
        edges = np.flatnonzero(np.diff(part)) + 1
        yield from zip(part[np.r_[0, edges]].tolist(), np.r_[0, edges], np.r_[edges, len(part)])


def sent_batch(rows: list[tuple[int, int, bytes]]) -> list[pa.Array]:
    columns = list(zip(*rows)) or [[], [], []]
    kinds = [pa.int32(), pa.int64(), pa.binary()]
    return [pa.array(c, k) for c, k in zip(columns, kinds)]
