"""Quality and toxicity: held-out accuracy, and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from talktally.llm import quality, toxicity
from talktally.llm.labelled import fitted_logistic
from tests.llm.helpers import documents, odd_rows, sentences


def fold(i: int, folds: int) -> int:
    return zlib.crc32(str(i).encode()) % folds


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_quality_is_learnt_outside_the_fold(spark):
    good = sentences(1, 150)
    bad = [" ".join(f"{w}$$$" for w in t.split()) for t in sentences(2, 60)]
    texts = good + bad
    rows = list(enumerate(texts)) + [(1000 + (i or 0), t) for i, t in odd_rows()]
    known = [(i, int(i < 150), 0, "x") for i in range(len(texts))]
    # Labels of the held-out fold are wrong on purpose: nothing may be learnt from them.
    known = [(i, 1 - q if fold(i, 5) == 0 else q, t, x) for i, q, t, x in known] + [(0, None, None, "x")]
    got = quality.classified(documents(spark, rows), labels(spark, known)).collect()
    assert len(got) == len(rows)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < len(texts)]
    assert np.mean([r["predicted"] == (r["doc_id"] < 150) for r in held]) > 0.9
    assert len({r["score"] for r in got if r["doc_id"] in (1001, 1002)}) == 1


def test_quality_without_labels_or_rows(spark):
    some, none = documents(spark, [(1, "a b"), (None, None)]), labels(spark, [])
    assert {r["score"] for r in quality.classified(some, none).collect()} == {0.5}
    assert quality.classified(documents(spark, []), none).count() == 0


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((80, 5))
    y = np.where(x @ [1.0, -2, 0.5, 0, 1] > 0, 1, -1)
    # Each row has places of its own for its values, and shares those of the weights below.
    values = np.concatenate([x.ravel(), np.zeros(0)])
    rows = [np.arange(5 * i, 5 * i + 5) for i in range(80)]
    apart = quality.dual_coordinate_descent(rows, np.ones(80), values, y, np.full(80, 10.0))
    assert ((apart * values).reshape(80, 5).sum(axis=1) * y > 0.9).all()
    some = [np.flatnonzero(rng.random(30) < 0.5) for _ in range(200)]
    truth, features = rng.standard_normal(30), rng.uniform(0.5, 2, 30)
    y = np.array([1 if (truth[p] * features[p]).sum() > 0 else -1 for p in some])
    w = quality.dual_coordinate_descent(some, np.ones(200), features, y, np.full(200, 10.0), rounds=300)
    assert np.mean([np.sign((w[p] * features[p]).sum()) == s for p, s in zip(some, y, strict=True)]) > 0.95


def test_accepted_keeps_whole_rows(spark):
    rows = documents(spark, odd_rows())
    flat = np.zeros(quality.PLACES)
    model = quality.QualityModel(flat, flat, 0.0, 0.0, 5.0)
    assert sorted(map(str, quality.accepted(rows, model).collect())) == sorted(map(str, rows.collect()))
    model.shift = -5.0
    assert quality.accepted(rows, model).count() == 0


@pytest.mark.parametrize(
    "text", ["you m0r0n", "YOU MORÓN", "mоrоn", "mo​ron!", "ＭＯＲＯＮ", "morons"]
)
def test_disguises_are_folded(text):
    model = toxicity.ToxicityModel({toxicity.folded("moron").strip(): 5.0})
    assert len(toxicity.matches(model.automaton(), toxicity.folded(text))) == 1


def test_exception_phrases_and_inner_matches_count_nothing():
    model = toxicity.ToxicityModel({toxicity.folded("clown").strip(): 5.0})
    found = model.automaton()

    def count(text):
        return len(toxicity.matches(found, toxicity.folded(text)))

    assert [count(t) for t in ("the class clown", "a Clown", "uncl0wned", "clown class clown clown")] == [0, 1, 0, 2]


def test_matching_equals_plain_search():
    rng = random.Random(3)
    model = toxicity.ToxicityModel({"ab": 1.0, "abc": 2.0, "b": 3.0}, exceptions=())
    found = model.automaton()
    for _ in range(300):
        text = toxicity.folded("".join(rng.choices("abc ", k=30)))
        want = sorted(
            (i, i + len(e) + 1, w)
            for e, w in model.lexicon.items()
            for i in range(len(text))
            if text.startswith(f" {e}", i)
        )
        assert sorted(toxicity.matches(found, text)) == want


def test_toxicity_is_learnt_outside_the_fold(spark):
    rng = random.Random(4)
    texts = sentences(5, 320)
    toxic = [i % 4 == 0 for i in range(320)]
    texts = [
        " ".join([*t.split()[:10], rng.choice(["zornwort", "zornwicht", "übelkerl"]), *t.split()[10:]]) if x else t
        for t, x in zip(texts, toxic, strict=True)
    ]
    rows = list(enumerate(texts)) + [(1000 + (i or 0), t) for i, t in odd_rows()]
    known = [(i, 1, int(x != (fold(i, 4) == 2)), "x") for i, x in enumerate(toxic)]
    got = toxicity.classified(documents(spark, rows), labels(spark, known)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 320]
    assert held and np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) > 0.95
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] >= 1000)


def test_toxicity_without_labels_or_rows(spark):
    some, none = documents(spark, [(1, "a b"), (None, None)]), labels(spark, [])
    assert [r["predicted"] for r in toxicity.classified(some, none).collect()] == [0, 0]
    assert toxicity.classified(documents(spark, []), none).count() == 0


def test_logistic_fit_is_finite_and_rising():
    slope, offset = fitted_logistic(np.array([0.0, 1, 2, 3]), np.array([0, 0, 1, 1]))
    assert 0 < slope < 100 and np.isfinite(offset)
    assert fitted_logistic(np.array([0.0, 1]), np.array([1, 0]))[0] == 0.0
    assert fitted_logistic(np.zeros(0), np.zeros(0)) == (1.0, 0.0)
