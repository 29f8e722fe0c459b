"""Words and word hashes of Arrow text columns, worked out on whole byte arrays.

All word rules of this subpackage separate on ASCII bytes only, so working on UTF-8 bytes gives
the same words as working on characters. Batches are taken in pieces of about a megabyte (or one
text, if that is longer), which bounds the memory of a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Words split at white space: every byte but the space and 0x09 to 0x0D.
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False

#: Words of letters and digits: 0-9, a-z after lower-casing, and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = True
ALNUM[97:123] = True
ALNUM[128:] = True

_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd base, modulo 2**64."""
    out = np.full(max(n, 1), np.uint64(_BASE))
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Piece:
    """Some consecutive rows of a batch: ``data`` is their text, row i is data[offsets[i]:offsets[i+1]]."""

    first_row: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, at_most: int = PIECE_BYTES):
    """The column in pieces of about ``at_most`` bytes; a longer text is a piece of its own."""
    data, offsets = flat_text(column)
    row = 0
    while row < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[row] + at_most, "right")) - 1
        last = min(max(last, row + 1), len(offsets) - 1)
        own = offsets[row: last + 1]
        yield Piece(row, data[own[0]: own[-1]], own - own[0])
        row = last


@dataclass
class Words:
    """The words of a piece in order: byte bounds, row, 64-bit hash; ``first`` has each row's first word."""

    lower: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray | None
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def words_of(piece: Piece, kind: np.ndarray, hashed: bool = True) -> Words:
    lower = _LOWER[piece.data]
    inside = kind[lower]
    n = len(inside)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = piece.offsets[:-1]
    cuts = cuts[cuts < n]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    lasts = piece.offsets[1:] - 1
    lasts = lasts[lasts >= 0]
    ends[lasts] = inside[lasts]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, piece.offsets)
    row = np.repeat(np.arange(piece.rows), np.diff(first))
    values = None
    if hashed and len(start):
        length = end - start
        at = np.cumsum(length) - length
        flat = lower[inside]
        within = np.arange(len(flat)) - np.repeat(at, length)
        values = _BYTE_VALUES[flat]
        values *= powers(int(length.max()))[within]
        values = mixed(np.add.reduceat(values, at) + length.astype(np.uint64))
    elif hashed:
        values = np.zeros(0, dtype=np.uint64)
    return Words(lower, start, end, row, values, first)


_ORDER = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words (rows are not looked at)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(count, np.uint64(n))
    for k in range(n):
        out += hashes[k: k + count] * _ORDER[k]
    return mixed(out)
