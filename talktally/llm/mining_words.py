"""Runs of words within pieces of many texts at once, by numpy.

A text is cut into pieces at . , ; : ! ? and line ends, a piece into words at spaces and
tabs; A-Z are taken in lower case. A phrase is a run of words of one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from talktally.llm.frames import row_blocks
from talktally.llm.words import BASE, byte_table, mix, segments, word_bounds, word_hashes

BLOCK = 1 << 21  # bytes of texts taken at a time
LONGEST = 4  # words of a phrase at most

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = byte_table(_PIECE_ENDS + b" \t")
_ENDS = np.zeros(256, np.int32)
_ENDS[list(_PIECE_ENDS)] = 1


@dataclass
class Block:
    """Words in order, as places in the bytes; runs are told from the word `fresh` on.

    follows[i] is whether the word i + 1 is of the same piece as the word i.
    """

    data: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    word_hashes: np.ndarray
    follows: np.ndarray
    fresh: int

    def hashes(self, size: int) -> np.ndarray:
        """Of the run of that many words from each word on."""
        count = max(len(self.starts) - size + 1, 0)
        with np.errstate(over="ignore"):
            out = np.full(count, size, np.uint64)
            for i in range(size):
                out = out * BASE + self.word_hashes[i : i + count]
            return mix(out)


@dataclass
class Phrases:
    """Phrases of one size: the word that each begins with, and its hash."""

    size: int
    at: np.ndarray
    hashes: np.ndarray

    def where(self, chosen: np.ndarray) -> Phrases:
        return Phrases(self.size, self.at[chosen], self.hashes[chosen])

    def distinct(self) -> tuple[Phrases, np.ndarray]:
        """One of each kind, and how many there are."""
        found, first, counts = np.unique(self.hashes, return_index=True, return_counts=True)
        return Phrases(self.size, self.at[first], found), counts

    def texts(self, block: Block) -> pa.Array:
        """The phrases with single spaces between their words."""
        word = self.at[:, None] + np.arange(self.size)
        starts = block.starts[word]
        length = block.stops[word] - starts
        length[:, :-1] += 1  # the byte after a word becomes the space
        ends = np.cumsum(length.ravel())
        total = int(ends[-1]) if len(ends) else 0
        begins = ends - length.ravel()
        at = np.arange(total) + np.repeat(starts.ravel() - begins, length.ravel())
        data = block.data[np.minimum(at, len(block.data) - 1)]
        data[data == 0xFF] = 0  # what byte_table has for the null character
        data[ends.reshape(length.shape)[:, :-1].ravel() - 1] = 0x20
        offsets = np.concatenate([[0], ends[self.size - 1 :: self.size]]).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.string(), len(self.at), buffers)


def _block(raw: np.ndarray, breaks: np.ndarray, before: int) -> Block:
    """The words of texts that begin at breaks; those that begin before that place are known."""
    folded = _TABLE[raw]
    starts, stops = word_bounds(folded, breaks)
    marks = np.zeros(len(raw) + 1, np.int32)
    marks[1:] = _ENDS[raw]
    inner = breaks[(breaks > 0) & (breaks < len(raw))]
    marks[inner + 1] += 1
    ends = np.cumsum(marks)
    follows = ends[starts[1:] + 1] == ends[stops[:-1]]
    hashes = word_hashes(folded, starts, stops)
    return Block(folded, starts, stops, hashes, follows, int(np.searchsorted(starts, before)))


def word_blocks(data: np.ndarray, ends: np.ndarray) -> Iterator[Block]:
    """The words of all texts; a very long text comes in parts that share a few words."""
    with np.errstate(over="ignore"):
        for first, last in row_blocks(ends, BLOCK):
            raw = data[ends[first] : ends[last]]
            if len(raw) <= BLOCK:
                yield _block(raw, ends[first:last] - ends[first], 0)
                continue
            begin = None
            for start, stop in segments(_TABLE[raw]):
                begin = start if begin is None else begin
                block = _block(raw[begin:stop], np.zeros(0, np.int64), start - begin)
                yield block
                if len(block.starts):
                    begin += int(block.starts[max(len(block.starts) - LONGEST + 1, 0)])


def phrases_of(block: Block, size: int, fits: np.ndarray | None = None, part: int = 1) -> Phrases:
    """Phrases of that many words, if given only those all of whose runs of part words fit."""
    hashes = block.hashes(size)
    count = len(hashes)
    valid = np.arange(count) + (size - 1) >= block.fresh
    for i in range(size - 1):
        valid &= block.follows[i : i + count]
    if fits is not None:
        for i in range(size - part + 1):
            valid &= fits[i : i + count]
    at = np.flatnonzero(valid)
    return Phrases(size, at, hashes[at])


def texts_of(batch: pa.RecordBatch, key: str) -> Iterator[tuple[np.int64, pa.Array]]:
    """Each key of a batch's rows and their texts."""
    keys = batch[key].to_numpy()
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        yield keys[rows[0]], batch["text"].take(pa.array(rows))
