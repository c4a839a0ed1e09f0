"""Quality of texts by a naive Bayes support vector machine on n-gram indicators.

A feature says whether a byte n-gram occurs in a text; n-grams share a fixed number of
places by a hash. Each is scaled by the log ratio of its counts in the two classes, a
text's features are scaled to unit length, and dual coordinate descent fits a linear
hinge-loss model, weighing errors of the two classes alike. A logistic curve on texts
that the fit has not seen turns the margin into the probability of label 1.

The model is fitted in one task on a bounded sample of labelled rows (`sample_rows`);
scoring reads every whole text. Null and empty texts have no features and score alike,
by the offset alone. Repeated rows score alike. With no labelled rows, or one class
only, every text scores the share of label 1, 0.5 if there is none. An empty table gives
no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talktally.llm.frames import id_and_text, row_blocks, trimmed, utf8
from talktally.llm.labelled import (
    fitted_logistic,
    fold_number,
    labelled_sample,
    logistic,
)

GRAM = 4
PLACES = 1 << 16
BLOCK, BLOCK_ROWS = 1 << 20, 256  # bytes and rows taken at a time
SAMPLE_ROWS = 8000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3


def indicators(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows: first, last, and row and place of each n-gram that occurs."""
    data, ends = utf8(texts)
    for first, last in row_blocks(ends, BLOCK, BLOCK_ROWS):
        seen = np.zeros((last - first) * PLACES, bool)
        for start in range(int(ends[first]), int(ends[last]), BLOCK):
            stop = min(start + BLOCK + GRAM - 1, int(ends[last]))
            count = stop - start - GRAM + 1
            if count <= 0:
                continue
            grams = np.ndarray(count, "<u4", data[start:stop].tobytes(), 0, (1,))
            place = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - 16)
            at = start + np.arange(count)
            row = np.searchsorted(ends, at, side="right") - 1
            whole = at + GRAM <= ends[row + 1]
            seen[((row - first) * PLACES + place)[whole]] = True
        found = np.flatnonzero(seen)
        yield first, last, found // PLACES, found % PLACES


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.ones((2, PLACES))
    for places, label in zip(rows, labels, strict=True):
        counts[label, places] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(
    rows: list[np.ndarray],
    scales: np.ndarray,
    features: np.ndarray,
    labels: np.ndarray,
    cost: np.ndarray,
    rounds: int = 15,
    seed: int = 7,
) -> np.ndarray:
    """Weights of the linear model with squared hinge loss; labels are 1 and -1.

    A row has the value scale * features[place] in each of its places. One dual variable
    a row; each step sets one to its best value with the others held.
    """
    rng = np.random.default_rng(seed)
    weights, dual = np.zeros(len(features)), np.zeros(len(rows))
    squares = np.array([(features[p] ** 2).sum() for p in rows]) * scales**2 + 1 / (2 * cost)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            places = rows[i]
            values = features[places] * scales[i]
            gradient = labels[i] * (weights[places] @ values) - 1 + dual[i] / (2 * cost[i])
            new = max(dual[i] - gradient / squares[i], 0.0)
            if new != dual[i]:
                weights[places] += (new - dual[i]) * labels[i] * values
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-4:
            break
    return weights


@dataclass
class QualityModel:
    """weights: of an n-gram's presence; squares: its share of a text's squared length."""

    weights: np.ndarray
    squares: np.ndarray
    offset: float
    slope: float
    shift: float

    def margins(self, row: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
        total = np.bincount(row, self.weights[place], rows)
        length = np.sqrt(np.bincount(row, self.squares[place], rows) + 1)
        return (total + self.offset) / length

    def scores(self, texts: pa.Array) -> np.ndarray:
        parts = [np.zeros(0)]
        for first, last, row, place in indicators(texts):
            margins = self.margins(row, place, last - first)
            parts.append(logistic(self.slope * margins + self.shift))
        return np.concatenate(parts)

    def to_bytes(self) -> bytes:
        numbers = [self.offset, self.slope, self.shift]
        return np.concatenate([self.weights, self.squares, numbers]).astype("<f8").tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> QualityModel:
        values = np.frombuffer(raw, "<f8")
        weights, squares = values[:PLACES], values[PLACES : 2 * PLACES]
        return QualityModel(weights, squares, *map(float, values[2 * PLACES :]))


def fitted(rows: list[np.ndarray], labels: np.ndarray, cost: float = 4.0) -> QualityModel:
    """A model from the places of each text's n-grams and the labels."""
    if len(set(labels.tolist())) < 2:
        share = float(labels[0]) if len(labels) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        flat = np.zeros(PLACES)
        return QualityModel(flat, flat, 0.0, 0.0, float(np.log(share / (1 - share))))
    # Every fifth row is left for the curve.
    apart = np.arange(len(rows)) % 5 == 4
    if len(set(labels[~apart].tolist())) < 2 or len(set(labels[apart].tolist())) < 2:
        apart[:] = False
    train = np.flatnonzero(~apart)
    ratio = log_count_ratio([rows[i] for i in train], labels[train])
    # The last feature is the offset, which every text has.
    features = np.append(ratio, 1.0)
    examples = [np.append(rows[i], np.int32(PLACES)) for i in train]
    scales = np.array([1 / np.sqrt((features[p] ** 2).sum()) for p in examples])
    share = labels[train].mean()
    costs = cost * np.where(labels[train] == 1, 0.5 / share, 0.5 / (1 - share))
    signs = 2 * labels[train] - 1
    weights = dual_coordinate_descent(examples, scales, features, signs, costs)
    model = QualityModel(weights[:-1] * ratio, ratio**2, float(weights[-1]), 1.0, 0.0)
    shown = np.flatnonzero(apart) if apart.any() else train
    margins = np.array([model.margins(np.zeros(len(rows[i]), np.int64), rows[i], 1)[0] for i in shown])
    model.slope, model.shift = fitted_logistic(margins, labels[shown])
    return model


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Fit on about sample_rows labelled rows outside the held-out fold."""
    sample = labelled_sample(documents, labels, label, folds, held_out, sample_rows)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, row, place in indicators(batch.column(0)):
                cuts = np.searchsorted(row, np.arange(last - first + 1))
                places = pa.ListArray.from_arrays(
                    pa.array(cuts.astype(np.int32)), pa.array(place.astype(np.int32))
                )
                known = batch.column(1).slice(first, last - first)
                yield pa.RecordBatch.from_arrays([known, places], names=["label", "places"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, known = [], []
        for batch in batches:
            known += batch.column(0).to_pylist()
            rows += [places.values.to_numpy() for places in batch.column(1)]
        # A fixed order, whatever order the rows have come in.
        order = sorted(range(len(rows)), key=lambda i: (len(rows[i]), rows[i].tobytes(), known[i]))
        order = np.random.default_rng(1).permutation(order).astype(int).tolist()
        model = fitted([rows[i] for i in order], np.array([known[i] for i in order], np.int64))
        yield pa.RecordBatch.from_pydict({"model": [model.to_bytes()]})

    encoded = sample.mapInArrow(trimmed(features), "label int, places array<int>").repartition(1)
    (row,) = encoded.mapInArrow(trimmed(fit), "model binary").collect()
    return QualityModel.from_bytes(bytes(row["model"]))


def quality_scores(
    documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, score and predicted for every text."""
    raw = documents.sparkSession.sparkContext.broadcast(model.to_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = QualityModel.from_bytes(raw.value)
        for batch in batches:
            scores = known.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores),
                    pa.array((scores >= threshold).astype(np.int32)),
                ],
                names=["doc_id", "score", "predicted"],
            )

    return id_and_text(documents).mapInArrow(trimmed(run), "doc_id long, score double, predicted int")


def accepted(
    documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The rows whose text is not rejected, with all their columns."""
    raw = documents.sparkSession.sparkContext.broadcast(model.to_bytes())
    at = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = QualityModel.from_bytes(raw.value)
        for batch in batches:
            yield batch.filter(pa.array(known.scores(batch.column(at)) >= threshold))

    return documents.mapInArrow(trimmed(run), documents.schema)


def classified(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's fold, score and prediction, learnt from the labels outside the fold."""
    scores = quality_scores(documents, fit_quality(documents, labels))
    return scores.select(
        "doc_id",
        F.coalesce(fold_number(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )
