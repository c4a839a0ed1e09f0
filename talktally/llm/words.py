"""Words of UTF-8 texts as 64-bit hashes, found for many texts at once with numpy.

A word is a run of bytes outside a set of ASCII separators; as those never occur inside
a longer UTF-8 character, bytes give the same words as characters. Equal words have
equal hashes; two different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

from talktally.llm.frames import row_blocks

BLOCK = 1 << 20  # bytes taken at a time, which bounds the memory of the arrays below
BASE = np.uint64(0x9E3779B97F4A7C55)
WHITE = bytes([0x20, *range(0x09, 0x0E)])


def byte_table(separators: bytes) -> np.ndarray:
    """For each byte, its value with A-Z in lower case, and 0 for a separator.

    The null character, no separator, has 255, which UTF-8 does not use.
    """
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    table[0] = 0xFF
    table[list(separators)] = 0
    return table


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]))
            for b in (BASE, inverse)
        )


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of the rows first to last of a batch, in order."""

    first: int
    last: int
    row: np.ndarray  # of each word, counted from the first row
    hashes: np.ndarray


def word_hashes(folded: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = 1 << max(int(len(folded)) - 1, BLOCK - 1).bit_length()
    up, down = _powers(size) if size <= 4 * BLOCK else _powers.__wrapped__(size)
    sums = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum(folded.astype(np.uint64) * up[: len(folded)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def word_bounds(folded: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = folded != 0
    change = np.empty(len(folded) + 1, bool)
    change[0], change[-1] = inside[:1].any(), inside[-1:].any()
    np.not_equal(inside[1:], inside[:-1], out=change[1:-1])
    at = np.flatnonzero(change)
    starts, stops = at[::2], at[1::2]
    # A text that ends in a word and one that begins with a word meet without a separator.
    cut = breaks[(breaks > 0) & (breaks < len(folded))]
    cut = np.unique(cut[inside[cut] & inside[cut - 1]])
    if len(cut):
        starts, stops = np.sort(np.append(starts, cut)), np.sort(np.append(stops, cut))
    return starts, stops


def segments(folded: np.ndarray) -> Iterator[tuple[int, int]]:
    """A very long text in parts that end at a separator."""
    start = 0
    while start < len(folded):
        stop = min(start + BLOCK, len(folded))
        while stop < len(folded) and folded[stop]:
            gap = np.flatnonzero(folded[stop : stop + BLOCK] == 0)
            stop = stop + int(gap[0]) if len(gap) else min(stop + BLOCK, len(folded))
        yield start, stop
        start = stop


def words_of(data: np.ndarray, ends: np.ndarray, table: np.ndarray) -> Iterator[Words]:
    """The words of all rows, in blocks of rows; numpy warnings of wrapping are off."""
    with np.errstate(over="ignore"):
        for first, last in row_blocks(ends, BLOCK):
            folded = table[data[ends[first] : ends[last]]]
            breaks = ends[first : last + 1] - ends[first]
            if len(folded) > BLOCK:
                parts = [
                    word_hashes(folded[a:b], *word_bounds(folded[a:b], np.zeros(0, np.int64)))
                    for a, b in segments(folded)
                ]
                hashes = np.concatenate(parts)
                yield Words(first, last, np.zeros(len(hashes), np.int64), hashes)
                continue
            starts, stops = word_bounds(folded, breaks)
            row = np.searchsorted(breaks, starts, side="right") - 1
            yield Words(first, last, row, word_hashes(folded, starts, stops))


def n_grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each run of n words within a row."""
    count = len(words.hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        hashes = np.full(count, n, np.uint64)
        for i in range(n):
            hashes = hashes * BASE + words.hashes[i : i + count]
        hashes = mix(hashes)
    whole = words.row[:count] == words.row[n - 1 :]
    return words.row[:count][whole], hashes[whole]
