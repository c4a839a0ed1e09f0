"""Toxicity of texts by a weighted lexicon that Aho-Corasick matches in folded text.

Folding makes equal what is written to look alike: compatibility forms, accents, letters
of other alphabets, digits and signs in place of letters, invisible characters. Lexicon
entries match at the beginning of a word. A match inside an exception phrase counts
nothing. The summed weights of a text are divided by a slowly growing function of its
words, and a logistic curve turns that into the probability of label 1.

Entries are words and word beginnings whose share of toxic texts is far above that of
other texts, counted by Spark over a bounded sample of labelled rows (`sample_rows`);
scoring reads every whole text. Null and empty texts have no match and score the least.
Repeated rows score alike. Without labelled rows the lexicon is empty. An empty table
gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talktally.llm.frames import id_and_text, trimmed
from talktally.llm.labelled import (
    fitted_logistic,
    fold_number,
    labelled_sample,
    logistic,
)

FOLDS, HELD_OUT = 4, 2
SAMPLE_ROWS = 12_000
THRESHOLD = 0.3
MOST_ENTRIES = 5000
LEAST_LETTERS, MOST_LETTERS = 4, 12
LEAST_TEXTS, LEAST_SHARE = 5, 0.004  # of the sample's toxic texts that an entry needs
LEAST_WEIGHT = 2.5  # log ratio of an entry's shares of toxic and other texts

# What each folded letter is also written as.
LOOK_ALIKES = {
    "a": "а@4αɑ",
    "b": "вЬ8β",
    "c": "сϲ¢",
    "d": "ԁɗ",
    "e": "еєε3€",
    "g": "ɡ9ց",
    "h": "һн",
    "i": "іıιlӏ1|ǀ",
    "j": "јϳ",
    "k": "кκ",
    "m": "мϻ",
    "n": "пη",
    "o": "оοσ0օ",
    "p": "рρ",
    "q": "ԛգ",
    "s": "ѕ5$ꜱ",
    "t": "тτ7",
    "u": "υսц",
    "v": "ѵν",
    "w": "ѡԝω",
    "x": "хχ",
    "y": "уγү",
    "z": "ᴢ2",
}
INVISIBLE = "­​‌‍⁠﻿"
# Harmless phrases with words that may be in the lexicon.
EXCEPTIONS = (
    "class clown",
    "clown fish",
    "circus clown",
    "pond scum",
    "trash can",
    "trash bin",
    "trash bag",
    "take out the trash",
)

_FOLD = {ord(c): to for to, many in LOOK_ALIKES.items() for c in many}
_FOLD |= {ord(c): None for c in INVISIBLE}
_GAPS = re.compile(r"[^\w]+")


def folded(text: str) -> str:
    """Lower-case letters without disguise, with one space between words and around all."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = "".join(c for c in text if not unicodedata.combining(c))
    return f" {_GAPS.sub(' ', text.lower().translate(_FOLD))} "


def beginnings(text: str) -> set[str]:
    """Each word of a folded text and its beginnings, of bounded length."""
    words = {w[:MOST_LETTERS] for w in set(text.split()) if len(w) >= LEAST_LETTERS}
    return {w[:n] for w in words for n in range(LEAST_LETTERS, len(w) + 1)}


def chosen_entries(
    counts: Iterable[tuple[str, int, int]], toxic: int, other: int, most: int = MOST_ENTRIES
) -> dict[str, float]:
    """Weights of entries, from how many toxic and other texts hold each beginning.

    Of beginnings of one word that nearly always occur together only the longest is kept,
    and none that a kept shorter one stands for.
    """
    held: dict[str, tuple[int, float]] = {}
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    for entry, in_toxic, in_other in counts:
        weight = np.log((in_toxic + 0.5) / (toxic + 1)) - np.log((in_other + 0.5) / (other + 1))
        if in_toxic >= least and weight >= LEAST_WEIGHT:
            held[entry] = in_toxic, float(weight)
    longest = {}
    for entry in sorted(held, key=lambda e: (-len(e), e)):
        shorter = entry[:-1]
        if shorter in held and held[entry][0] >= 0.9 * held[shorter][0]:
            longest[shorter] = longest.get(entry, entry)
    kept: dict[str, float] = {}
    covered: set[str] = set()
    for entry in sorted(held, key=lambda e: (len(e), e)):
        if not any(entry[:n] in covered for n in range(LEAST_LETTERS, len(entry))):
            covered.add(entry)
            whole = longest.get(entry, entry)
            kept[whole] = held[whole][1]
    best = sorted(kept, key=lambda e: (-kept[e] * held[e][0], e))[:most]
    return {e: kept[e] for e in sorted(best)}


@dataclass
class ToxicityModel:
    """Entries in folded form with their weights, and the curve of the scores."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 1.0
    shift: float = -2.0

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.lexicon.items():
            found.add_word(f" {entry}", (weight, len(entry) + 1))
        for phrase in self.exceptions:
            found.add_word(folded(phrase), (0.0, len(folded(phrase))))
        if len(found):
            found.make_automaton()
        return found


def matches(automaton: ahocorasick.Automaton, text: str) -> list[tuple[int, int, float]]:
    """Start, stop and weight of each entry found outside exception phrases, in a folded text."""
    if not len(automaton):
        return []
    hits, spared = [], []
    for end, (weight, size) in automaton.iter(text):
        (hits if weight else spared).append((end + 1 - size, end + 1, weight))
    if not spared:
        return hits
    kept, at = [], 0
    spared.sort()
    for hit in sorted(hits):
        while at < len(spared) and spared[at][1] < hit[1]:
            at += 1
        if at == len(spared) or spared[at][0] > hit[0]:
            kept.append(hit)
    return kept


def strength(automaton: ahocorasick.Automaton, text: str) -> tuple[float, int]:
    """The summed weights by length, and how many entries were found."""
    plain = folded(text)
    found = matches(automaton, plain)
    return sum(w for *_, w in found) / np.log2(4 + plain.count(" ")), len(found)


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    sample_rows: int = SAMPLE_ROWS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> ToxicityModel:
    """Learn entries, weights and curve from about sample_rows labelled rows outside the fold."""
    sample = labelled_sample(documents, labels, label, folds, held_out, sample_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, is_toxic in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                counts[is_toxic].update(beginnings(folded(text)))
                counts[is_toxic][""] += 1
        entries = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_pydict(
            {
                "entry": pa.array(entries, pa.string()),
                "toxic": pa.array([counts[1][e] for e in entries], pa.int64()),
                "other": pa.array([counts[0][e] for e in entries], pa.int64()),
            }
        )

    counted = (
        sample.mapInArrow(trimmed(count), "entry string, toxic long, other long")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where((F.col("entry") == "") | (F.col("toxic") >= LEAST_TEXTS))
    )
    counts = {r["entry"]: (r["toxic"], r["other"]) for r in counted.collect()}
    toxic, other = counts.pop("", (0, 0))
    rows = ((e, *c) for e, c in counts.items())
    model = ToxicityModel(chosen_entries(rows, toxic, other), exceptions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            found = [strength(automaton, t)[0] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.float64()), batch.column(1)], names=["strength", "label"]
            )

    seen = sample.mapInArrow(trimmed(measure), "strength double, label int").toPandas()
    if len(set(seen["label"])) == 2:
        seen = seen.sort_values(["strength", "label"])
        model.slope, model.shift = fitted_logistic(
            seen["strength"].to_numpy(), seen["label"].to_numpy()
        )
    return model


def scores_of(
    model: ToxicityModel, automaton: ahocorasick.Automaton, texts: pa.Array
) -> tuple[np.ndarray, list[int]]:
    found = [strength(automaton, t.as_py() or "") for t in texts]
    strengths = np.array([s for s, _ in found], np.float64)
    return logistic(model.slope * strengths + model.shift), [n for _, n in found]


def accepted(
    documents: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The rows whose text is not rejected, with all their columns."""
    at = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            yield batch.filter(pa.array(scores_of(model, automaton, batch.column(at))[0] < threshold))

    return documents.mapInArrow(trimmed(run), documents.schema)


def toxicity_scores(
    documents: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, n_matches, score and predicted for every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            scores, found = scores_of(model, automaton, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(found, pa.int64()),
                    pa.array(scores),
                    pa.array((scores >= threshold).astype(np.int32)),
                ],
                names=["doc_id", "n_matches", "score", "predicted"],
            )

    schema = "doc_id long, n_matches long, score double, predicted int"
    return id_and_text(documents).mapInArrow(trimmed(run), schema)


def classified(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's fold, score and prediction, learnt from the labels outside the fold."""
    scores = toxicity_scores(documents, fit_toxicity(documents, labels))
    held_out = F.coalesce(fold_number(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scores.withColumn("held_out", held_out)
