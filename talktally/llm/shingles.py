"""Sets of word shingles as sorted 64-bit hashes, found for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from talktally.llm.frames import utf8
from talktally.llm.words import BASE, WHITE, byte_table, mix, n_grams, words_of

WORDS = 5
_TABLE = byte_table(WHITE)
_SALT = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Sets:
    """The sets of the rows first to last: row i has atoms[ends[i]:ends[i + 1]], ascending.

    names has a hash of each set, the same for equal sets; an empty set's is 0.
    """

    first: int
    last: int
    atoms: np.ndarray
    ends: np.ndarray
    names: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), np.diff(self.ends))


def _whole_sequences(rows: np.ndarray, hashes: np.ndarray, count: np.ndarray, most: int):
    """For rows of 1 to most words, all of them as one shingle."""
    first = np.cumsum(count) - count
    for n in range(1, most + 1):
        at = np.flatnonzero(count == n)
        total = np.full(len(at), n, np.uint64)
        for i in range(n):
            total = total * BASE + hashes[first[at] + i]
        yield at, mix(total)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[Sets]:
    """The sets of distinct shingles of all texts, in blocks of rows."""
    data, ends = utf8(texts)
    with np.errstate(over="ignore"):
        for block in words_of(data, ends, _TABLE):
            rows = block.last - block.first
            count = np.bincount(block.row, minlength=rows)
            row, atoms = n_grams(block, words)
            parts = [(row, atoms), *_whole_sequences(block.row, block.hashes, count, words - 1)]
            row = np.concatenate([r for r, _ in parts])
            atoms = np.concatenate([a for _, a in parts])
            order = np.lexsort((atoms, row))
            row, atoms = row[order], atoms[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (atoms[1:] != atoms[:-1])
            row, atoms = row[new], atoms[new]
            cuts = np.searchsorted(row, np.arange(rows + 1))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(atoms ^ _SALT))])
            size = np.diff(cuts).astype(np.uint64)
            names = mix(sums[cuts[1:]] - sums[cuts[:-1]] + size * _SALT)
            yield Sets(block.first, block.last, atoms, cuts, np.where(size == 0, np.uint64(0), names))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many atoms two ascending sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
