"""Vectorised text kernels shared by the operators of this subpackage.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``. All kernels work on
the UTF-8 buffer of an Arrow string column, in blocks of bounded size, so a
partition never holds more than one batch of rows and a few times one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one vectorised step takes (a longer document is taken alone).
BLOCK_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1 rows) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]] if len(column) else data[:0], offsets - (offsets[0] if len(offsets) else 0)


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most limit bytes together, or a single row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """Words of consecutive rows: byte ranges, row numbers and 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        self.rows = len(offsets) - 1
        self.data = data
        inside = (data != 0x20) & ((data - np.uint8(9)) > 4)
        edge = np.empty(len(data) + 1, bool)
        edge[1:-1] = inside[1:] & ~inside[:-1]
        edge[0], edge[-1] = bool(len(data)) and inside[0], False
        cuts = offsets[1:-1]
        cuts = cuts[cuts < len(data)]
        edge[cuts] = inside[cuts]
        self.start = np.flatnonzero(edge)
        edge[1:-1] = inside[:-1] & ~inside[1:]
        edge[0], edge[-1] = False, bool(len(data)) and inside[-1]
        cuts = cuts[cuts > 0]
        edge[cuts] |= inside[cuts - 1]
        self.length = np.flatnonzero(edge) - self.start
        self.first = np.searchsorted(self.start, offsets)  # of each row, its first word
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))
        self.lower = lower
        self._hashes: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        """By words of eight bytes; the length goes in first. Made once; not to be written to."""
        if self._hashes is None:
            self._hashes = self._hash()
        return self._hashes

    def _hash(self) -> np.ndarray:
        data = np.concatenate([_LOWER[self.data] if self.lower else self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), np.dtype("<u8"), data, 0, (1,))
        out = mix(self.length.astype(np.uint64) * _P ^ (eight[self.start] & _MASK[np.minimum(self.length, 8)]) * _Q)
        far, k = np.flatnonzero(self.length > 8), 8
        while len(far):
            out[far] = mix(out[far] * _P + (eight[self.start[far] + k] & _MASK[np.minimum(self.length[far] - k, 8)]))
            k += 8
            far = far[self.length[far] > k]
        return out

    def texts(self, chosen: np.ndarray | None = None) -> list[bytes]:
        raw = (_LOWER[self.data] if self.lower else self.data).tobytes()
        start = self.start if chosen is None else self.start[chosen]
        end = start + (self.length if chosen is None else self.length[chosen])
        return [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` consecutive hashes (by doubling, in O(n log size))."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    out, have, power, span = None, 0, hashes, 1
    factor = np.uint64(0xA24BAED4963EE407)
    left = size
    while left:
        if left & 1:
            if out is None:
                out, have = power, span
            else:
                n = len(hashes) - have - span + 1
                out = mix(out[:n] * np.uint64(0x9FB21C651E98DF25) + power[have : have + n])
                have += span
        left >>= 1
        if left:
            n = len(power) - span
            power = mix(power[:n] * factor + power[span : span + n])
            span *= 2
    return out


def seeded_crc10(ids) -> np.ndarray:
    """crc32 of the ids' decimal texts."""
    import zlib

    return np.array([zlib.crc32(str(x).encode()) for x in ids], dtype=np.int64)
