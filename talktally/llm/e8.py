"""The lattice E8: nearest points, and the cells next to them."""

from __future__ import annotations

from functools import cache
from itertools import combinations, product

import numpy as np


@cache
def shortest() -> np.ndarray:
    """The 240 shortest vectors: two entries of 1 or -1, or halves with an even number of signs."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    halves = [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if s.count(-1.0) % 2 == 0]
    return np.array(whole + halves)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole entries of even sum."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    near[rows, worst[rows]] += np.where(off[rows, worst[rows]] >= 0, 1.0, -1.0)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """The lattice point nearest each row: the better of the whole and the half ones."""
    whole = _nearest_even(x)
    half = _nearest_even(x - 0.5) + 0.5
    better = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(better[:, None], half, whole)


def around(x: np.ndarray, point: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The count neighbours of each row's point that are nearest the row, and how much further."""
    gain = (x - point) @ shortest().T  # squared distance grows by 2 - 2 * gain
    best = np.argpartition(-gain, min(count, 239), axis=1)[:, :count]
    further = 2 - 2 * np.take_along_axis(gain, best, axis=1)
    return point[:, None, :] + shortest()[best], further
