"""Byte and word arrays of many texts at once, for functions that run on Arrow batches.

A word here is a run of bytes other than ASCII white space, unless a module says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_TABLES = [np.random.default_rng(7 + s).integers(1, 1 << 63, 256, dtype=np.uint64) for s in range(2)]
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; a bijection."""
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def _powers(n: int, seed: int, inverse: bool) -> np.ndarray:
    have = _POWERS.get((seed, inverse))
    if have is None or len(have) < n:
        base = pow(_ODD[seed], -1, 1 << 64) if inverse else _ODD[seed]
        size = max(n, 1 << 16)
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        have = _POWERS[seed, inverse] = np.cumprod(powers, dtype=np.uint64)
    return have[:n]


def prefix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Prefix sums from which the hash of any run of values follows."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values), seed, False), out=out[1:], dtype=np.uint64)
    return out


def runs_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the values from ``start`` to ``end`` (excluded), the same wherever they stand."""
    inverse = _powers(len(sums), seed, True)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def rolling(sums: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` values."""
    n = len(sums) - length
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[length:] - sums[:n]) * _powers(n, seed, True) + U64(length))


def sliding(values: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """Least (or greatest) of each ``width`` neighbours, from running extremes of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    fill = np.iinfo(values.dtype).max if best is np.minimum else 0
    whole = np.full(-(-len(values) // width) * width, fill, values.dtype)
    whole[:len(values)] = values
    blocks = whole.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n], ahead[width - 1:width - 1 + n])


class Block:
    """Texts laid one behind the other with a line feed between them."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts) + b"\n"
        self.bytes = np.frombuffer(self.raw, np.uint8)
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths

    def byte_sums(self, seed: int = 0) -> np.ndarray:
        return prefix(_TABLES[seed][self.bytes], seed)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and for each text its first word and the one behind its last."""
        space = _SPACE[self.bytes]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
        starts, ends = edge[::2], edge[1::2]
        return starts, ends, np.searchsorted(starts, self.start), np.searchsorted(starts, self.end)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [t or b"" for t in column.to_pylist()]


def ranges(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text; one longer text is a range of its own."""
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) or
                                  pa.types.is_large_binary(column.type) else np.int32)
                    [column.offset:column.offset + len(column) + 1]).tolist() if len(column) else []
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def pieces(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, list[bytes]]]:
    """The :func:`ranges` with their texts."""
    for first, end in ranges(column, limit):
        yield first, end, texts_of(column.slice(first, end - first))


def split_by(order_key: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, to) for each run of equal values of a sorted array."""
    if not len(order_key):
        return []
    cut = np.flatnonzero(np.diff(order_key)) + 1
    edges = [0, *cut.tolist(), len(order_key)]
    return [(int(order_key[a]), a, b) for a, b in zip(edges, edges[1:])]
