"""Near duplicates of texts and vectors, and components, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from talktally.llm import e8, jaccard_join
from talktally.llm.components import components
from talktally.llm.embedding_dedup import Lattice, linked_embeddings
from tests.llm.helpers import documents, odd_rows


def smallest_reachable(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text: str | None) -> set:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_join(rows) -> dict:
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[:n]
        if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in smallest_reachable(ids, links).items()}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(40)]
    rows = spark.createDataFrame([*links, (None, 1), (5, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(rows).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == smallest_reachable(nodes, links)
    assert components(rows.limit(0)).count() == 0


def near_copies(seed: int, count: int) -> list[tuple[int, str]]:
    """Edited copies of few texts, one of them for a third of all, some with a common passage."""
    rng = random.Random(seed)
    bases = [
        [rng.choice("abcdefghijklmnop") * 2 + str(rng.randint(0, 60)) for _ in range(rng.randint(3, 120))]
        for _ in range(15)
    ]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(count):
        words = list(bases[0] if rng.random() < 0.33 else rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = rng.choice("xyz") + str(rng.randint(0, 9))
        if rng.random() < 0.3:
            words += passage
        rows.append((i, " ".join(words)))
    return rows


def test_jaccard_join_equals_brute_force_through_pivots_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 6)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 3)
    monkeypatch.setattr(jaccard_join, "SAMPLE_OF", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 900)
    rows = near_copies(2, 400)
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == plain_join(rows)


def test_jaccard_join_of_odd_rows(spark):
    rows = odd_rows() + [(20, "one two three"), (21, "ONE  two\nthree"), (22, "one two three four")]
    got = sorted(map(str, (tuple(r) for r in jaccard_join.near_duplicates(documents(spark, rows)).collect())))
    want = plain_join([r for r in rows if r[0] is not None])
    named = [(i, *want[i]) for i, _ in rows if i is not None]
    alone = (None, len(shingles(odd_rows()[-1][1])), None)
    assert got == sorted(map(str, [*named, alone]))


def test_texts_without_an_id_take_part_in_links(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(7, " ".join(w[8:])), (None, " ".join(w)), (None, " ".join(w).upper()), (3, " ".join(w[:52]))]
    got = jaccard_join.near_duplicates(documents(spark, rows)).collect()
    # Those with an id link only with the text without one.
    assert sorted(map(str, map(tuple, got))) == sorted(
        map(str, [(7, 48, 3), (None, 56, 3), (None, 56, 3), (3, 48, 3)])
    )
    got = jaccard_join.near_duplicates(documents(spark, rows[::3])).collect()
    assert sorted(map(tuple, got)) == [(3, 48, 3), (7, 48, 7)]


def test_jaccard_join_of_no_rows(spark):
    assert jaccard_join.near_duplicates(documents(spark, [])).count() == 0
    got = jaccard_join.near_duplicates(documents(spark, [(1, None), (2, "")])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 0, 2)]


def test_nearest_lattice_points():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 8)) * 1.5
    point = e8.nearest(x)
    beside, further = e8.around(x, point, 239)
    apart = ((x - point) ** 2).sum(axis=1)
    assert (((x[:, None] - beside) ** 2).sum(axis=2) >= apart[:, None] - 1e-9).all()
    assert np.allclose(((x[:, None] - beside) ** 2).sum(axis=2) - apart[:, None], further)
    assert ((point * 2) % 1 == 0).all() and (point.sum(axis=1) % 2 == 0).all()


@pytest.mark.parametrize("cosine", [0.95, 0.97])
def test_like_vectors_meet(cosine):
    rng = np.random.default_rng(2)
    a, b = rng.standard_normal((2, 2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1)[:, None]
    cells = Lattice(64)
    x, y = cells.cells(a), cells.cells(b)
    assert (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= 0.95


def pairs_at(cosine: float, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.random.default_rng(seed).standard_normal((2, count, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    return a, cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1)[:, None]


@pytest.mark.parametrize("rows", [200_000, 100_000_000])
def test_links_of_large_tables_are_found_as_well(spark, monkeypatch, rows):
    a, b = pairs_at(0.951, 400, 5)
    vectors = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate([*a, *b])], "vec_id long, embedding array<double>"
    )
    # As if the table had so many rows.
    monkeypatch.setattr(type(vectors), "count", lambda self: rows)
    found = linked_embeddings(vectors).collect()
    assert sum(r["n_links"] for r in found) / 800 >= 0.95


def test_linked_embeddings(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 16))
    rows = []
    for i in range(400):
        near = centres[0 if i % 3 == 0 else rng.integers(30)]
        noise = rng.standard_normal(16) * rng.choice([0, 0.03, 0.05])
        rows.append((i, [float(np.float32(x)) for x in near + noise]))
    odd = [
        (700, None), (701, []), (702, [0.0] * 16), (703, [1.0] * 15 + [None]), (705, [1.0] * 3),
        (704, [1.0] * 15 + [float("nan")]), (707, [1.0] * 15 + [float("inf")]), (None, rows[5][1]),
    ]
    rows.append((600, [x * 1000 for x in rows[7][1]]))
    vectors = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in rows + odd], "vec_id long, embedding array<double>, cell string, links int"
    )
    got = {r["vec_id"]: tuple(r) for r in linked_embeddings(vectors, block_rows=40).collect()}
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    like = x @ x.T
    # The vectors leave no pair near the bound, so that all links are found.
    linked = np.argwhere(np.triu(like >= 0.95, 1))
    assert not ((like > 0.9499) & (like < 0.9501)).any()
    want = smallest_reachable(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in linked])
    degree = (like >= 0.95).sum(axis=1) - 1
    found = sum(got[int(i)][1] for i in ids) / degree.sum()
    assert 0.99 <= found <= 1
    assert np.mean([got[i][2] == c for i, c in want.items()]) >= 0.99
    assert all(got[i] == (i, 0, i, True) for i, _ in odd if i is not None)
    assert got[None] == (None, 0, None, False)


def test_links_within_one_block_of_a_cell_count_once(spark):
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(64)
    x = centre + 0.33 * rng.standard_normal((150, 64))
    x[:30] = x[30:60] + 0.01 * rng.standard_normal((30, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    like = x @ x.T
    degree = (like >= 0.95).sum(axis=1) - 1
    assert degree.sum() == 60 and not ((like > 0.949) & (like < 0.951)).any()
    vectors = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"
    )
    got = {r["vec_id"]: r["n_links"] for r in linked_embeddings(vectors, block_rows=8).collect()}
    assert got == dict(enumerate(degree.tolist()))


def test_vectors_of_each_length_link_among_themselves(spark):
    rng = np.random.default_rng(8)
    rows = []
    for size, count in [(16, 40), (24, 30), (3, 6), (1, 2)]:
        x = rng.standard_normal((count // 2, size)) if size > 3 else np.eye(size)
        for v in x:
            rows += [v.tolist(), (v * (1 + 0.01 * rng.standard_normal(size))).tolist()]
    # Beginning like another vector is no link, nor is an id that rows of two lengths share.
    rows.append([*rows[0], *[0.0] * 8])
    vectors = spark.createDataFrame(
        [(i, v) for i, v in enumerate(rows)] + [(2, rows[40])], "vec_id long, embedding array<double>"
    )
    got = sorted(map(tuple, linked_embeddings(vectors).collect()))
    want = [(i, 1 + (i in (40, 41)), i - i % 2, i % 2 == 0) for i in range(len(rows) - 1)]
    want[2] = (2, 1, 2, True)
    want[40], want[41] = (40, 2, 2, False), (41, 2, 2, False)
    last = len(rows) - 1
    assert got == sorted([*want, (2, 2, 2, True), (last, 0, last, True)])


def test_equal_vectors_count_each_other(spark):
    rows = [(3, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 4.0]), (9, [-1.0, 2.0]), (9, [-1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, linked_embeddings(vectors).collect()))
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (9, 1, 9, True), (9, 1, 9, True)]
    assert linked_embeddings(vectors.limit(0)).count() == 0
