"""Winnowed benchmark passages against a plain search for every window."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from talktally.llm import decontamination
from tests.llm.helpers import CLASHING, documents, odd_rows, sentences


def words(text: str | None) -> list[str]:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def plain(rows, items, window=10) -> list[tuple]:
    known: dict[tuple, set] = {}
    for item_id, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w and item_id is not None else 0):
            known.setdefault(tuple(w[i : i + size]), set()).add(str(item_id))
    out = []
    for doc_id, text in rows:
        w, hit, held = words(text), set(), set()
        for size in {len(k) for k in known}:
            for i in range(len(w) - size + 1):
                if ids := known.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    held |= ids
        sha = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(held), sha, bool(hit)))
    return sorted(out, key=str)


def benchmark(spark, items):
    schema = "item_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *["x"] * len(CLASHING)) for i, t in items], schema)


def found(spark, rows, items, **options) -> list[tuple]:
    table = decontamination.contaminated(documents(spark, rows), benchmark(spark, items), **options)
    return sorted((tuple(r) for r in table.collect()), key=str)


def planted(seed: int) -> tuple[list, list]:
    """Documents of few words, so that grams repeat, with cut and whole passages of items."""
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(["a", "b", "ü", "D4", "e"], k=rng.randrange(8, 40)))) for i in range(30)]
    items += [(100 + i, t) for i, t in enumerate(sentences(seed, 20, 25))]
    items += [(200, items[31][1]), (5, sentences(seed + 1, 1, 14)[0])]
    rows = []
    for i, text in enumerate(sentences(seed + 2, 60, 40)):
        w, passage = text.split(), rng.choice(items)[1].split()
        start = rng.randrange(len(passage))
        at = rng.randrange(len(w))
        cut = passage[start : start + rng.randrange(1, 30)]
        rows.append((i, " ".join(w[:at] + [c.upper() + "," for c in cut] + w[at:])))
    rows += [(900, " ".join(rng.choices("ab", k=400))), (901, "a " * 300), (902, items[33][1] * 2)]
    return rows, items


@pytest.mark.parametrize("most_broadcast", [decontamination.MOST_BROADCAST, 0])
def test_all_windows_are_met(spark, most_broadcast):
    rows, items = planted(3)
    assert found(spark, rows, items, most_broadcast=most_broadcast) == plain(rows, items)


@pytest.mark.parametrize("most_broadcast", [decontamination.MOST_BROADCAST, 0])
def test_short_and_odd_items_and_documents(spark, most_broadcast):
    items = [
        (1, "sat on the mat"),
        (2, "a"),
        (3, None),
        (4, "  ..."),
        (None, "the dog"),
        (6, "x"),
        (7, "looked at the dog, the CAT sat on the mat and looked at"),
        (8, "かな"),
        (1, "the cat"),
    ]
    rows = [*odd_rows(), (50, "The cat sat on the mat and looked at the dog the cat sat on the mat and looked at")]
    assert found(spark, rows, items, most_broadcast=most_broadcast) == plain(rows, items)


def test_constant_runs_and_ties(spark):
    items = [(1, "a " * 12), (2, "a " * 9 + "b"), (3, "a " * 4)]
    rows = [(i, "a " * i + "b " + "a " * (20 - i)) for i in range(20)]
    assert found(spark, rows, items) == plain(rows, items)


def test_other_windows(spark):
    rows, items = planted(8)
    assert found(spark, rows, items, window=7, gram=5) == plain(rows, items, window=7)


def test_empty_tables(spark):
    rows, items = planted(4)
    assert found(spark, [], items) == []
    assert found(spark, rows, []) == plain(rows, [])
    assert found(spark, [(1, None), (1, "")], items) == plain([(1, None), (1, "")], items)


def test_fingerprints_of_shared_windows_meet(spark):
    """Every window of ten words has a fingerprint of its own text, whatever is around it."""
    rng = random.Random(5)
    passage = [f"w{rng.randrange(50)}" for _ in range(10)]
    texts = [
        [f"x{rng.randrange(9)}" for _ in range(rng.randrange(6))] + passage + [f"y{rng.randrange(9)}" for _ in range(5)]
        for _ in range(50)
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, words array<string>")
    kept = decontamination.fingerprints(rows).collect()
    inside = {(r["id"], r["gram"]) for r in kept if 0 <= r["at"] - r["words"].index(passage[0]) <= 4}
    grams = [{g for i, g in inside if i == n} for n in range(50)]
    assert set.intersection(*grams)


def test_no_python_in_the_plan(spark):
    rows, items = planted(3)
    table = decontamination.contaminated(documents(spark, rows), benchmark(spark, items))
    plan = table._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD.*Project", plan.replace("LogicalRDD", ""))
