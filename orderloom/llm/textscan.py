"""Vectorised word hashing over Arrow string columns, used inside tasks.

Texts are bytes here.  A word is a longest run of bytes that are not separators, its
hash 64 bits wide: a polynomial over per-byte random values (prefix sums turn it into
two lookups per word), then a final mix.  Work goes in blocks of whole rows of about
``BLOCK`` bytes, and a longer text is hashed in pieces that end at a separator, so the
memory is bounded by a block plus the words of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

_BASE = 0x9E3779B97F4A7C15

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# ASCII other than letters and digits; bytes of longer code points belong to words
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor, shift, multiply twice)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    raw = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw, offs.astype(np.int64)


class WordHasher:
    """Hashes words; one per task, as it keeps its tables of powers."""

    def __init__(self, separators: np.ndarray = SPACE, fold: np.ndarray = SAME, seed: int = 7):
        rng = np.random.default_rng(seed)
        values = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.separators = separators
        self.values = values[fold]
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << int(n).bit_length()
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def hash_rows(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word and the row it is in; ``offs`` are the rows' bounds in data."""
        n = len(data)
        if n == 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        inside = ~self.separators[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offs[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self._powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:n], out=sums[1:])
        hashes = mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))
        return hashes, np.searchsorted(offs, start, side="right") - 1

    def _long(self, data: np.ndarray) -> np.ndarray:
        parts, at = [], 0
        while at < len(data):
            cut = min(at + BLOCK, len(data))
            if cut < len(data):
                found = np.flatnonzero(self.separators[data[at:cut]])
                if len(found):
                    cut = at + int(found[-1]) + 1
                else:
                    beyond = np.flatnonzero(self.separators[data[cut:]])
                    cut = cut + int(beyond[0]) + 1 if len(beyond) else len(data)
            parts.append(self.hash_rows(data[at:cut], np.array([0, cut - at]))[0])
            at = cut
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def blocks(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Yield (first row, row after the last, word hashes, row of each word from 0)."""
        data, offs = text_buffers(column)
        at, rows = 0, len(offs) - 1
        while at < rows:
            to = int(np.searchsorted(offs, offs[at] + BLOCK, side="right")) - 1
            to = min(max(to, at + 1), rows)
            piece = data[offs[at] : offs[to]]
            if to == at + 1 and len(piece) > BLOCK:
                hashes = self._long(piece)
                yield at, to, hashes, np.zeros(len(hashes), np.int64)
            else:
                yield at, to, *self.hash_rows(piece, offs[at : to + 1] - offs[at])
            at = to


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each row's values; ``bounds`` has one more entry than rows."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


_STEPS = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63)


def ngrams(
    hashes: np.ndarray, rows: np.ndarray, offsets: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the words at ``offsets`` from each word, and the word's place.

    Only where the last offset is still in the same row.  ``offsets`` starts with 0.
    """
    span = offsets[-1]
    m = len(hashes) - span
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(m, np.uint64)
    for k, off in enumerate(offsets):
        step = (_STEPS[k % 4] * (2 * (k // 4) + 1) + 2 * k) | 1
        total += hashes[off : off + m] * np.uint64(step % 2**64)
    places = np.flatnonzero(rows[:m] == rows[span:])
    return mix(total[places] + np.uint64(len(offsets))), places


def shingles(
    hashes: np.ndarray, rows: np.ndarray, n_rows: int, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as (hash, row), sorted by row and hash.

    A row with fewer than ``size`` words has its whole sequence as its only shingle, a
    row without words none.
    """
    grams, places = ngrams(hashes, rows, tuple(range(size)))
    gram_rows = rows[places]
    words = np.bincount(rows, minlength=n_rows)
    for length in range(1, size):
        short = words[rows] == length if len(rows) else np.empty(0, bool)
        if short.any():
            own, at = ngrams(hashes[short], rows[short], tuple(range(length)))
            grams = np.concatenate([grams, own])
            gram_rows = np.concatenate([gram_rows, rows[short][at]])
    order = np.lexsort((grams, gram_rows))
    grams, gram_rows = grams[order], gram_rows[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (gram_rows[1:] != gram_rows[:-1])
    return grams[fresh], gram_rows[fresh]


def bounds_of(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Bounds of each row in a sorted array of row numbers."""
    return np.searchsorted(rows, np.arange(n_rows + 1))
