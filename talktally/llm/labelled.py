"""A bounded, repeatable sample of labelled texts, and scores turned into probabilities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talktally.llm.frames import id_and_text

HASH_RANGE = 1 << 30


def fold_number(doc_id, folds: int):
    """crc32 of the id as text, modulo the folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, about: int
) -> DataFrame:
    """text and label (0 or 1) of about that many rows outside the held-out fold, or of all.

    Which rows is decided by a hash of their id, so that it is the same at every run. Rows
    without a label, and labels other than 0 and 1, take no part.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(fold_number(F.col("doc_id"), folds) != held_out)
        .dropDuplicates(["doc_id"])
    )
    share = min(1.0, about / max(1, known.count()))
    chosen = known.where(
        F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE)) < F.lit(int(share * HASH_RANGE))
    )
    # At most about as many ids as the sample has rows, whatever the tables hold.
    return id_and_text(documents).join(F.broadcast(chosen), "doc_id").select("text", "label")


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fitted_logistic(
    score: np.ndarray, label: np.ndarray, ridge: float = 1e-3
) -> tuple[float, float]:
    """Slope and offset that make a score a probability, by Newton's method.

    The targets are drawn in a little from 0 and 1, so that separable scores have a finite
    fit; the slope is never negative.
    """
    if len(score) == 0:
        return 1.0, 0.0
    ones = float(label.sum())
    target = np.where(label > 0, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    at = np.zeros(2)
    design = np.column_stack([score, np.ones_like(score)])

    def loss(x: np.ndarray) -> float:
        z = design @ x
        return float(np.sum(np.logaddexp(0, z) - target * z) + ridge * x @ x / 2)

    for _ in range(50):
        p = logistic(design @ at)
        gradient = design.T @ (p - target) + ridge * at
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    if at[0] < 0:
        share = (ones + 1) / (len(label) + 2)
        return 0.0, float(np.log(share / (1 - share)))
    return float(at[0]), float(at[1])
