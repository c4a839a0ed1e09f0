"""Exact integer matrix products by residue number systems, in float32 throughout.

Integers are taken modulo several small primes, as residues nearest to zero. Products of two
residues summed over a slice of bounded length stay below 2**24, where float32 is exact, so
that each prime's matrix product is exact however it is ordered. The digits of a mixed
radix with those primes (Chinese remaindering after Garner) are again small residues nearest
to zero, and give the signed product without a last correction.
"""

from __future__ import annotations

from functools import cache

import numpy as np

LARGEST_PRIME = 251
EXACT = 1 << 24  # float32 holds all integers up to here
MOST = 1 << 62  # products up to here fit a long


@cache
def _primes() -> tuple[int, ...]:
    """Odd primes from the largest down."""
    found = [p for p in range(3, LARGEST_PRIME + 1, 2) if all(p % q for q in range(3, p, 2))]
    return tuple(reversed(found))


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as tell all integers from -bound to bound apart."""
    product, count = 1, 0
    while product < 2 * bound + 1:
        product *= _primes()[count]
        count += 1
    return _primes()[: max(count, 1)]


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, at most p / 2 from zero or as near to it as rounding makes it."""
    q = np.rint(x * x.dtype.type(1 / p))
    q *= -p
    q += x
    return q


def residues(values: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """Residues of whole numbers held as float64, of any size, as float32."""
    out = []
    for p in primes:
        r = np.fmod(values, p)
        r[r > p // 2] -= p
        r[r < -(p // 2)] += p
        out.append(r.astype(np.float32))
    return out


def _product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a times b transposed, modulo p."""
    most = EXACT // (p // 2 + 1) ** 2
    total = None
    for start in range(0, max(a.shape[1], 1), most):
        part = _centred(a[:, start : start + most] @ b[:, start : start + most].T, p)
        total = part if total is None else _centred(total + part, p)
    return total


def _signed(parts: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The numbers that have these residues, as int64; sums beyond it wrap and come back."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        digit = parts[k]
        for j in range(k):
            digit = _centred((digit - digits[j]) * np.float32(pow(primes[j], -1, p)), p)
        digits.append(digit)
    total = digits[-1].astype(np.int64)
    for digit, p in zip(reversed(digits[:-1]), reversed(primes[: len(digits) - 1]), strict=True):
        total *= p
        total += digit.astype(np.int64)
    return total


def bound_of(a: np.ndarray, b: np.ndarray) -> int:
    """What no product of a row of a with a row of b exceeds."""
    most = [int(np.abs(x).max()) if x.size else 0 for x in (a, b)]
    return a.shape[1] * most[0] * most[1]


class Factor:
    """One side of products, with its residues worked out once for each set of primes."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self._known: dict[tuple[int, ...], list[np.ndarray]] = {}

    def residues(self, primes: tuple[int, ...]) -> list[np.ndarray]:
        if primes not in self._known:
            self._known = {primes: residues(self.values, primes)}
        return self._known[primes]


def products(a: Factor, b: np.ndarray) -> np.ndarray:
    """The exact inner products of the rows of a and b, whole numbers held as float64."""
    bound = bound_of(a.values, b)
    if bound >= MOST:
        raise ValueError("inner products may pass 2**62; scale the vectors down")
    primes = primes_for(bound)
    pairs = zip(a.residues(primes), residues(b, primes), primes, strict=True)
    return _signed([_product(x, y, p) for x, y, p in pairs], primes)
