"""Residue-number products and mined negatives against plain integers."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from talktally.llm import hard_negatives, rns

SCHEMA = "vec_id long, label int, embedding array<float>, score string, block string, row string, n string"


@pytest.mark.parametrize("size,most", [(1, 1), (3, 200), (64, 500), (1500, 255), (64, 10**6), (5, 10**8)])
def test_products_are_exact(size, most):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(-most, most + 1, (n, size)) for n in (17, 23))
    a[0], b[0], b[1] = most, most, -most
    want = a.astype(object) @ b.T.astype(object)
    got = rns.products(rns.Factor(a.astype(np.float64)), b.astype(np.float64))
    assert got.dtype == np.int64 and (got == want).all()


def test_products_of_nothing_and_of_too_much():
    none = rns.products(rns.Factor(np.zeros((2, 0))), np.zeros((3, 0)))
    assert none.tolist() == [[0, 0, 0]] * 2
    with pytest.raises(ValueError):
        rns.products(rns.Factor(np.full((1, 2), 2.0**40)), np.full((1, 2), 2.0**40))


def test_windows():
    scores = np.array([0, 1, 2, 19, 20, 21, 39, 40, -1, -40, 2**62])
    low, high = hard_negatives.window_of(scores)
    for s, a, b in zip(scores.tolist(), low.tolist(), high.tolist(), strict=True):
        assert 50 * s <= 100 * a < 50 * s + 100
        assert 95 * s - 100 < 100 * b <= 95 * s


def plain(rows) -> Counter:
    used = []
    for i, label, v in rows:
        if None in (i, label, v) or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in v]
        used.append((i, (label + 1) % 10 if i % 7 == 0 else label, whole))
    out = []
    for n, (i, label, v) in enumerate(used):
        if i % 50:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w, strict=True)), j, other)
            for m, (j, other, w) in enumerate(used)
            if m != n and len(v) == len(w)
        ]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fit = sorted(x for x in scored if x[2] != label and -50 * s <= -100 * x[0] <= -95 * s)
            out += [(i, j, r, k, -s, -t) for r, (t, k, _) in enumerate(fit[:3], 1)]
    return Counter(out)


def found(spark, rows) -> Counter:
    table = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    got = hard_negatives.hard_negatives(table)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in got.select(columns).collect())


def vectors(seed: int, count: int, size: int = 8) -> list[tuple]:
    """Of a few directions, rounded so that scores tie; label 1 has a third of all rows."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((4, size))
    out = []
    for i in range(count):
        v = base[rng.integers(4)] + 0.6 * rng.standard_normal(size)
        label = 1 if rng.random() < 0.33 else int(rng.integers(10))
        out.append((i, label, [round(float(x), 1) for x in v]))
    return out


def test_negatives_are_those_of_a_plain_search(spark):
    rows = vectors(1, 900)
    assert found(spark, rows) == plain(rows)


def test_many_blocks_give_the_same(spark, monkeypatch):
    rows = vectors(2, 700) + [(1000 + i, 1, vectors(2, 1)[0][2]) for i in range(120)]
    monkeypatch.setattr(hard_negatives, "BLOCK_NUMBERS", 400)
    monkeypatch.setattr(hard_negatives, "ANCHOR_NUMBERS", 40)
    monkeypatch.setattr(hard_negatives, "TILE", 60)
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [
        *vectors(3, 200),
        (None, 1, [1.0] * 8),
        (201, None, [1.0] * 8),
        (202, 1, None),
        (203, 2, [1.0] * 7 + [None]),
        (204, 2, [math.nan] * 8),
        (205, 2, [math.inf] * 8),
        (206, 2, []),
        (250, 3, []),
        (207, 3, []),
        (208, 2, [0.0] * 8),
        (300, 2, [0.0] * 8),
        (350, 5, [2.0, 3.0]),
        (351, 6, [2.0, 2.0]),
        (353, 6, [1.0, 2.5]),
        (-50, -3, [1.0] * 8),
        (-49, -3, [0.9] * 8),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == Counter()
    assert found(spark, rows[200:206]) == Counter()


def test_repeated_rows_are_rows_of_their_own(spark):
    rng = random.Random(4)
    rows = vectors(5, 150)
    repeated = [(0, 3, rows[0][2])] * 2 + [rng.choice(rows) for _ in range(40)]
    got, want = found(spark, rows + repeated), plain(rows + repeated)
    assert got == want
