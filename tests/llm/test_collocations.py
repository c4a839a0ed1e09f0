"""Mined collocations against plain counts of every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from talktally.llm import collocations, mining_words
from talktally.llm.collocations import Mining
from talktally.llm.frames import utf8
from tests.llm.helpers import odd_rows

EXTRA = ["phrase", "size", "n", "slot", "shard", "hash", "a", "k"]
SCHEMA = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in EXTRA)


def pieces(text: str | None) -> list[list[str]]:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", text)]


def plain(rows, support=30, top=2000, longest=4) -> list[tuple]:
    words, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            words[lang] += len(w)
            for size in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    candidates = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= support}
    covered = Counter()
    for (lang, p), n in candidates.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                part = (lang, p[i : i + size])
                covered[part] = max(covered[part], n)
    scored = []
    for (lang, p), a in candidates.items():
        if 100 * covered[lang, p] >= 80 * a:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        scored.append((lang, -score, -a, " ".join(p).encode(), left, right))
    out, ranks = [], Counter()
    for lang, score, a, phrase, left, right in sorted(scored):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], phrase.decode(), -a, left, right, words[lang], -score))
    return out


def found(spark, rows, **options) -> list[tuple]:
    table = spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], SCHEMA)
    got = collocations.collocations(table, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed: int, count: int, langs=("en", "de", None)) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("N", "ö", "漢", "k", "st") for b in ("a", "e", "i", "\x00")]
    weights = [1 / (i + 1) for i in range(len(words))]
    phrases = [" ".join(rng.choices(words, k=rng.randrange(2, 6))) for _ in range(12)]
    rows = []
    for i in range(count):
        lang = rng.choice(langs)
        parts = []
        for _ in range(rng.randrange(1, 12)):
            more = rng.choices(words, weights, k=rng.randrange(0, 6))
            parts.append(" ".join([*more, rng.choice(phrases)] if rng.random() < 0.6 else more))
        text = parts[0]
        for part in parts[1:]:
            text += rng.choice([". ", ",", "\n", " \t ", "! ?", " ", " ", "\x0b"]) + part
        rows.append((i, text, lang))
    return rows


@pytest.mark.parametrize("shards", [1, 4, 7])
def test_phrases_are_those_of_a_plain_count(spark, shards):
    rows = corpus(1, 700)
    want = plain(rows)
    assert len(want) > 100
    assert found(spark, rows, mining=Mining(shards=shards)) == want


def test_a_full_filter_loses_nothing(spark):
    rows = corpus(2, 250)
    assert found(spark, rows, mining=Mining(most_filter_bits=8)) == plain(rows)


def test_other_supports_and_tops(spark):
    rows = corpus(3, 200)
    assert found(spark, rows, mining=Mining(support=3, shards=2), top=25) == plain(rows, 3, 25)


def test_hot_and_unequal_shards(spark):
    """One text a third of the rows, and languages of very different size."""
    rows = corpus(4, 200, ("en",)) + [(900 + i, "Hot text, one HOT text of many.", "en") for i in range(120)]
    rows += corpus(5, 40, ("x",)) + [(5, "just the one", "y")] * 31 + [(None, "just one", "y")] * 30
    assert found(spark, rows) == plain(rows)


def test_odd_rows_and_empty_tables(spark):
    rows = [(i, t, None) for i, t in odd_rows()] * 4
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, None, "en"), (2, "...", None)]) == []


def test_supports_keep_every_frequent_phrase(spark):
    """Counts one below each shard's support never add up to the support."""
    rng = random.Random(6)
    rows = [(lang, s, rng.randrange(1, 10**6)) for lang in "abcdef" for s in range(rng.randrange(1, 9))]
    slots = [(i, lang, lang, n) for i, (lang, _, n) in enumerate(rows)]
    words = spark.createDataFrame(slots, "slot long, whole string, lang string, n long")
    least = Counter()
    for r in collocations.supports(words.select("slot", "n"), words.drop("n"), 30).collect():
        assert r["least"] >= 1
        least[r["lang"]] += r["least"] - 1
    assert set(least) <= set("abcdef") and max(least.values()) < 30


def test_very_long_texts_come_in_parts(monkeypatch):
    from talktally.llm import words

    monkeypatch.setattr(words, "BLOCK", 64)
    monkeypatch.setattr(mining_words, "BLOCK", 64)
    rng = random.Random(7)
    text = "".join(rng.choice(["a", "b", "cc ", " ", " dd", ". ", "é", "\t"]) for _ in range(3000))
    texts = [text, "", "a b", "x" * 300, text[:70]]
    got = Counter()
    for block in mining_words.word_blocks(*utf8(pa.array(texts))):
        for size in range(1, 5):
            one, counts = mining_words.phrases_of(block, size).distinct()
            for phrase, n in zip(one.texts(block).to_pylist(), counts.tolist(), strict=True):
                got[phrase] += n
    want = Counter()
    for t in texts:
        for w in pieces(t):
            for size in range(1, 5):
                want.update(" ".join(w[i : i + size]) for i in range(len(w) - size + 1))
    assert got == want


@pytest.mark.parametrize("most_bits", [30, 13])
def test_filter_holds_what_was_set(spark, most_bits):
    rows = spark.range(0, 5000, 7).selectExpr("id as hash", "5L as of", "'x' as chunk")
    held = collocations.filter_of(rows.union(rows), "of", most_bits)
    assert held.bits == min(most_bits, 15)
    has = held.has(np.arange(8192).astype(np.uint64), np.int64(5))
    assert np.flatnonzero(has).tolist() == list(range(0, 5000, 7))
    assert collocations.filter_of(rows.limit(0), "of", most_bits).bits == 8


def test_filters_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BITS", 6)
    rows = spark.range(2000).selectExpr("xxhash64(id) as hash", "0L as of")
    held = collocations.filter_of(rows, "of", 20)
    hashes = np.array([r["hash"] for r in rows.collect()]).view(np.uint64)
    assert held.has(hashes, np.int64(0)).all()
    assert held.has(hashes + np.uint64(1), np.int64(0)).mean() < 0.15
