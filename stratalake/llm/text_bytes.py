"""Hashes of all substrings of a batch of texts at once, over the UTF-8 bytes that Arrow holds.

A prefix sum of ``code[byte] * base ** position`` (modulo 2 ** 64, an odd base) gives the hash of
any stretch of bytes by one subtraction and one product; the same over word hashes gives those of
any run of words. Everything here works on one batch inside one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text that are worked on at once; a longer document is worked on alone.
CHUNK = 2_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all 64."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class Hasher:
    """Hashes of stretches of a sequence of 64-bit codes; ``seed`` picks one function of many."""

    def __init__(self, seed: int):
        numbers = np.random.default_rng(seed)
        self.codes = numbers.integers(0, 2**64, 256, dtype=U64)
        self.base = int(numbers.integers(0, 2**64, dtype=U64)) | 1
        self.inverse = pow(self.base, -1, 2**64)
        self.powers = self.inverses = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n + 1:
            size = max(n + 1, 2 * len(self.powers))
            for name, factor in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, factor, U64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=U64))

    def prefix(self, codes: np.ndarray) -> np.ndarray:
        self._grow(len(codes))
        out = np.zeros(len(codes) + 1, U64)
        np.cumsum(codes * self.powers[: len(codes)], dtype=U64, out=out[1:])
        return out

    def of_bytes(self, data: np.ndarray) -> np.ndarray:
        return self.prefix(self.codes[data])

    def between(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((prefix[ends] - prefix[starts]) * self.inverses[starts])

    def windows(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """The hash of every stretch of ``length``, by start."""
        n = max(0, len(prefix) - length)
        return mixed((prefix[length:] - prefix[:n]) * self.inverses[:n])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of strings, and where each string starts; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return every[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(bounds: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; at least a row each."""
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def word_table(pattern_bytes: set[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(pattern_bytes)] = True
    return out


#: Bytes that are part of a word: all but blanks; and letters, digits and all of other scripts.
NOT_BLANK = word_table(set(range(256)) - {0x20, *range(0x09, 0x0E)})
LETTERS = word_table(
    {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def words_in(
    data: np.ndarray, bounds: np.ndarray, letters: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in ``data``, and per document the index of its first word.

    ``bounds`` are the documents' first bytes and the end; words end with their document.
    """
    inside = letters[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    first_bytes = bounds[:-1][bounds[:-1] < len(data)]
    before[first_bytes] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:] & ~(inside & ~before)[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)
