"""Words of whole Arrow batches as arrays of 64-bit hashes.

One pass of numpy over the text buffer finds where words begin and end and hashes
every word; no Python object is made per word. Texts are taken in runs of about
``RUN_BYTES`` (a longer text is a run of its own), which bounds what a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 21

# White space of the word pattern [^\x20\x09-\x0D]+.
WHITE_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(WHITE_SPACE)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Odd factors between the members of a gram.
GRAM_FACTOR, OTHER_FACTOR = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F

# An odd base has an inverse modulo 2**64, so a word's hash does not depend on where it stands.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    factors = np.full(n + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Run:
    """Words of some consecutive texts: ``hashes[bounds[i]:bounds[i+1]]`` are text i's."""

    first: int
    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def texts(self) -> Iterator[tuple[int, np.ndarray]]:
        for i in range(len(self)):
            yield self.first + i, self.hashes[self.bounds[i] : self.bounds[i + 1]]

    def grams(self, length: int, factor: int = GRAM_FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every window of ``length`` words that stays in its text, and bounds by text.

        Hashes of two factors tell windows apart by 128 bits.
        """
        n = len(self.hashes) - length + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.zeros(len(self) + 1, np.int64)
        h = gram_hashes(self.hashes, length, factor)
        counts = np.maximum(np.diff(self.bounds) - length + 1, 0)
        owner = np.repeat(np.arange(len(self)), np.diff(self.bounds))
        return h[owner[:n] == owner[length - 1 :]], np.concatenate([[0], np.cumsum(counts)])


def gram_hashes(hashes: np.ndarray, length: int, factor: int = GRAM_FACTOR) -> np.ndarray:
    """Hash of every ``length`` consecutive values."""
    n = len(hashes) - length + 1
    h = hashes[:n].copy()
    for k in range(1, length):
        h *= np.uint64(factor)
        h += hashes[k : k + n]
    return mixed(h)


def runs(column: pa.Array | pa.ChunkedArray, lower: bool) -> Iterator[Run]:
    """Runs of the texts of a string column; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.empty(0, np.uint8)
    longest = max(RUN_BYTES, int(np.diff(offsets).max(initial=0)))
    powers = _power(_BASE, longest), _power(_INVERSE, longest)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + RUN_BYTES, side="right")) - 1)
        j = min(j, len(column))
        yield _run(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower, powers)
        i = j


def _run(first: int, data: np.ndarray, offsets: np.ndarray, lower: bool, powers) -> Run:
    up, down = powers
    if lower:
        data = LOWER[data]
    word = IS_WORD[data]
    begins, ends_here = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends_here[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] |= word[inner]
    ends_here[inner - 1] |= word[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends_here) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    bounds = np.searchsorted(starts, offsets)
    return Run(first, mixed(hashes), bounds, starts, ends, data)
