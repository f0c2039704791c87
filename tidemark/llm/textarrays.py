"""Words, hashes and shingles of whole Arrow text columns as NumPy arrays.

Texts are handled as UTF-8 bytes, a bounded number of bytes at a time (one text longer than
that is handled whole). Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
#: A random 64-bit value for each byte, from a fixed seed.
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=U64)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that are not the white space of ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, lower-case letters and all bytes of characters beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, CHUNK_BYTES + 1), base, U64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[base] = table
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows: (number of the first row, their bytes, offsets of each row in these)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


@dataclass
class Words:
    """Words of a run of rows: byte positions, hashes, and where each row's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray  # offsets into the words, one more than rows

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


class RangeHash:
    """64-bit hashes of byte ranges, from one running sum; equal ranges have equal hashes."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE_VALUES[data] * _power_table(_MULTIPLIER, len(data) + 1)[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = _power_table(_INVERSE, len(self.sums))
        value = (self.sums[ends] - self.sums[starts]) * back[starts]
        return mix(value + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    """Maximal runs of word bytes, none across rows."""
    data = LOWER[data] if lower else data
    mask = is_word[data]
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    finishes = mask.copy()
    finishes[:-1] &= ~mask[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = mask[inner]
    finishes[inner - 1] = mask[inner - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    return Words(starts, ends, RangeHash(data)(starts, ends), np.searchsorted(starts, offsets))


#: Odd multipliers that tell the places of a word sequence apart.
_PLACES = np.random.default_rng(7).integers(1, 1 << 62, 64, dtype=U64) * U64(2) + U64(1)


def sequence_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` values, by its first place (rows are not looked at)."""
    n = max(0, len(hashes) - length + 1)
    out = np.zeros(n, U64)
    for j in range(length):
        out += hashes[j : j + n] * _PLACES[j]
    return mix(out + U64(length))


def shingle_sets(w: Words, size: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its shingles; a shorter row is one shingle."""
    whole = sequence_hashes(w.hashes, size)
    out = []
    for lo, hi in zip(w.rows[:-1].tolist(), w.rows[1:].tolist(), strict=True):
        if hi - lo >= size:
            out.append(np.unique(whole[lo : hi - size + 1]))
        elif hi > lo:
            out.append(sequence_hashes(w.hashes[lo:hi], hi - lo))
        else:
            out.append(np.zeros(0, U64))
    return out


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list<int64> column of arrays of 64-bit values."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, U64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
