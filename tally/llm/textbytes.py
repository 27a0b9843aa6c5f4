"""Vectorised views of a batch of texts as UTF-8 bytes.

A batch's string column is one byte array with offsets. Words, shingles and
substrings get 64-bit names from one polynomial prefix sum over the bytes, so
that no Python object is made per word. Blocks of a few megabytes bound the
memory, a single longer text being a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (so that order and bits are even)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _values(seed: int) -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64) * _ODD + _U(seed))


EXACT = _values(1)
LOWER = EXACT.copy()            # A-Z named like a-z
LOWER[65:91] = EXACT[97:123]

_bytes = np.arange(256)
SPACE = (_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13))
#: Letters, digits and all bytes of non-ASCII characters.
WORDY = ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90)) \
    | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128)

_BASE, _INVERSE = _U(0xD1342543DE82EF95), _U(pow(0xD1342543DE82EF95, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        row = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        row[0] = 1
        have = _powers[kind] = np.cumprod(row, dtype=np.uint64)
    return have[:n]


class Block:
    """Consecutive texts of a batch: ``data`` bytes and ``offsets`` of the texts in it."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def sums(self, values: np.ndarray = EXACT) -> np.ndarray:
        """Prefix sums for ``names``."""
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(values[self.data] * _power("up", _BASE, len(self.data) or 1)[:len(self.data)], out=out[1:])
        return out

    @staticmethod
    def names(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Names of the byte strings [start, end): equal strings have equal names."""
        return (sums[end] - sums[start]) * _power("down", _INVERSE, len(sums))[start]

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of member bytes, none across texts."""
        m = member[self.data]
        if not len(m):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = np.zeros(len(m) + 1, bool)
        cut[self.offsets] = True
        before, after = np.empty_like(m), np.empty_like(m)
        before[0], before[1:] = False, m[:-1]
        after[-1], after[:-1] = False, m[1:]
        return np.flatnonzero(m & (~before | cut[:-1])), np.flatnonzero(m & (~after | cut[1:])) + 1

    def words(self, member: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and 64-bit names of the words, and each text's range of words."""
        start, end = self.runs(member)
        names = mix(self.names(self.sums(values), start, end) + (end - start).astype(np.uint64) * _ODD)
        return start, end, names, np.searchsorted(start, self.offsets)


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of an Arrow string column in blocks; null texts count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    at = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield Block(lo, raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
        lo = hi


def shingles(names: np.ndarray, lo: int, hi: int, size: int) -> np.ndarray:
    """Sorted distinct names of the ``size``-word shingles of words lo..hi.

    Fewer words than ``size``: the whole sequence as one; no words: none.
    """
    n = hi - lo
    if n <= 0:
        return np.zeros(0, np.uint64)
    width = min(n, size)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total = total * _BASE + names[lo + k:lo + k + n - width + 1]
    return np.unique(mix(total))


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices start..start+size of each entry, one after another."""
    total = np.cumsum(size)
    return np.repeat(start - (total - size), size) + np.arange(total[-1] if len(total) else 0)


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> pa.Array:
    """A string per row: its pieces at[k]..at[k+1], the UTF-8 bytes data[start:end] each, joined by one space."""
    size = end - start + 1
    last = np.cumsum(size)
    out = np.append(data, np.uint8(32))[ragged(start, size)] if len(size) else np.zeros(0, np.uint8)
    out[last - 1] = 32
    ends = np.concatenate([[0], last])[at]
    some = np.flatnonzero(np.diff(at) > 0)
    out = np.delete(out, ends[some + 1] - 1)        # no space after a row's last piece
    ends[1:] -= np.cumsum(np.diff(at) > 0)
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out))
