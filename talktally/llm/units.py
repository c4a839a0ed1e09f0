"""Token ids of whole texts at the cost of one library call for each distinct short unit.

The byte-level pattern `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|...`
never joins a character that is not white space to white space after it, nor a letter to
a character after it that is not a letter. A text may thus be cut at those places and its
parts encoded apart: their ids in order are the ids of the whole. Texts that contain a
special string are encoded whole.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

from talktally.llm.frames import row_blocks

BLOCK = 1 << 21
MOST_KNOWN = 600_000  # units that a worker remembers
LONG = 16  # bytes; longer units are encoded each time

_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x0A, 0x09, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SOLID = np.zeros(256, bool)  # ASCII characters that are no white space of any kind
_SOLID[0x21:0x7F] = True
# What ends a unit after a letter. Non-ASCII bytes may be letters, and the apostrophe may
# begin a contraction, which is a unit's start as well but is left inside to be plain.
_NOT_LETTER = np.zeros(256, bool)
_NOT_LETTER[0x21:0x7F] = True
_NOT_LETTER &= ~_LETTER
_NOT_LETTER[0x27] = False


def unit_starts(data: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Where units begin, among them every text's beginning."""
    start = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        before, here = data[:-1], data[1:]
        solid = _SOLID[before]
        # Two-byte characters U+00C0 to U+00FF are letters or signs, never white space.
        solid[1:] |= (data[:-2] == 0xC3) & (before[1:] >= 0x80)
        start[1:-1] = (solid & _WHITE[here]) | (_LETTER[before] & _NOT_LETTER[here])
    start[breaks] = True
    start[-1] = False
    return np.flatnonzero(start)


@dataclass
class Tokens:
    """The ids of the rows first to last of a batch: row i has ids[ends[i]:ends[i + 1]]."""

    first: int
    last: int
    ids: np.ndarray
    ends: np.ndarray


class UnitEncoder:
    """Encodes texts by units.

    encode takes a list of texts and gives the ids of each; whole takes one text, which
    has a special string. starts says where texts may be cut.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[list[int]]],
        whole: Callable[[str], list[int]],
        special: tuple[bytes, ...],
        starts: Callable[[np.ndarray, np.ndarray], np.ndarray] = unit_starts,
    ):
        self._encode, self._whole, self._special = encode, whole, special
        self._starts = starts
        self._known: dict[bytes, bytes] = {}

    def _ids(self, units: list[bytes]) -> list[bytes]:
        """The ids of each unit as unsigned 32-bit numbers."""
        known = self._known
        found = list(map(known.get, units))
        new = [i for i, ids in enumerate(found) if ids is None]
        encoded = self._encode([units[i].decode("utf-8") for i in new])
        for i, ids in zip(new, encoded, strict=True):
            found[i] = array("I", ids).tobytes()
            if len(units[i]) <= LONG and len(known) < MOST_KNOWN:
                known[units[i]] = found[i]
        return found

    def _plain(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special strings, and how many there are before each text's end."""
        starts = self._starts(data, breaks[:-1][np.diff(breaks) > 0])
        stops = np.append(starts[1:], len(data))
        length = stops - starts
        raw = data.tobytes()
        # Equal units are found by two 64-bit words that hold all their bytes.
        padded = raw + bytes(LONG)
        low, high = (
            np.ndarray(len(data), "<u8", padded, 8 * word, (1,))[starts]
            & _MASK[np.clip(length - 8 * word, 0, 8)]
            for word in range(2)
        )
        with np.errstate(over="ignore"):
            code = (low ^ length.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            code = ((code >> np.uint64(29)) ^ code ^ high) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.argsort(code, kind="stable")
        ranked = code[order]
        new = np.empty(len(order), bool)
        new[:1] = True
        np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
        one = order[new]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        first = one[which]
        same = (low[first] == low) & (high[first] == high) & (length[first] == length)
        same &= length <= LONG
        # Long units, and any whose code is another's too, are taken one by one.
        odd = np.flatnonzero(~same)
        which[odd] = len(one) + np.arange(len(odd))
        shown = np.concatenate([one, odd])
        at = zip(starts[shown].tolist(), stops[shown].tolist(), strict=True)
        ids = self._ids([raw[a:b] for a, b in at])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        begins = np.cumsum(sizes) - sizes
        count = sizes[which]
        total = np.cumsum(count)
        at = np.arange(int(count.sum()), dtype=np.int64)
        at += np.repeat(begins[which] - (total - count), count)
        until = np.searchsorted(starts, breaks, side="left")
        return flat[at], np.concatenate([[0], total])[until]

    def batches(self, data: np.ndarray, ends: np.ndarray) -> Iterator[Tokens]:
        """The ids of all rows, in blocks of rows; a very long row is taken in parts."""
        for first, last in row_blocks(ends, BLOCK):
            part, breaks = data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
            if any(s in part.tobytes() for s in self._special):
                yield self._with_special(part, breaks, first, last)
            elif len(part) > BLOCK:
                starts = self._starts(part, np.zeros(1, np.int64))
                at = np.searchsorted(starts, np.arange(BLOCK, len(part), BLOCK))
                cuts = [0, *np.unique(starts[at[at < len(starts)]]).tolist(), len(part)]
                ids = [
                    self._plain(part[a:b], np.array([0, b - a]))[0]
                    for a, b in zip(cuts, cuts[1:], strict=False)
                ]
                ids = np.concatenate(ids)
                yield Tokens(first, last, ids, np.array([0, len(ids)]))
            else:
                yield Tokens(first, last, *self._plain(part, breaks))

    def _with_special(self, part: np.ndarray, breaks: np.ndarray, first: int, last: int) -> Tokens:
        found = []
        for a, b in zip(breaks, breaks[1:], strict=False):
            text = part[a:b].tobytes()
            if any(s in text for s in self._special):
                found.append(np.array(self._whole(text.decode("utf-8")), np.uint32))
            else:
                found.append(self._plain(part[a:b], np.array([0, b - a]))[0])
        ends = np.cumsum([0, *map(len, found)])
        return Tokens(first, last, np.concatenate([np.zeros(0, np.uint32), *found]), ends)
