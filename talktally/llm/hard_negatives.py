"""Hard negatives of anchors, by exact scores from residue-number matrix products.

Components become whole numbers and scores their inner products (see rns), so that ties are
ties. Anchors meet all other rows in blocks of bounded size: first those of their own label,
of which the best are their positives, then all rows again, of which for each positive the
best rows of other labels are kept whose scores lie within its window. A pair of blocks gives
only its best rows for each anchor, which Spark ranks.

A window holds scores from half of the positive's to 95 percent of it; where the positive's
score is negative it holds none. Rows without an id or a label, and those whose vector is null
or holds null or non-finite numbers, take no part. Vectors meet only those of their length;
empty ones have scores of 0. Repeated rows of one id are rows of their own: an anchor's
copy may be its positive, each copy of an anchor gives its own rows, and of equal scores
and ids any comes first. An empty table gives no rows. Other columns are ignored. Scores
are longs; vectors whose products may pass 2**62 raise an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talktally.llm.frames import stored
from talktally.llm.rns import Factor, products

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
BLOCK_NUMBERS = 1 << 19  # components of the rows in a block, 4 MB
ANCHOR_NUMBERS = 1 << 19  # and of the anchors that meet them; like sizes shuffle least
TILE = 1 << 20  # scores worked out at a time

_LOW = -np.iinfo(np.int64).max  # can be negated


def usable(embeddings: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """vec_id, label, size and vector, in whole numbers, of the rows that take part."""
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite)


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose id that number divides have the next label."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels)
    return rows.withColumn("label", moved.otherwise(F.col("label")))


def _blocks(count: str, numbers: int) -> Column:
    each = F.greatest(F.col("size"), F.lit(1)).cast("long")
    return F.greatest(F.ceil(F.col(count) * each / numbers), F.lit(1)).cast("int")


def _dealt(rows: DataFrame, anchors: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both with keys, block and part, so that each anchor meets all rows of its keys."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    counts = counts.join(anchors.groupBy(*keys).agg(F.count("*").alias("n_anchors")), keys)
    sizes = counts.select(
        *keys,
        _blocks("n", BLOCK_NUMBERS).alias("parts"),
        _blocks("n_anchors", ANCHOR_NUMBERS).alias("blocks"),
    )

    def place(of: str, salt: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.col(of)).cast("int")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    left = anchors.join(sizes, keys).withColumn("block", place("blocks", 1))
    right = rows.join(sizes, keys).withColumn("part", place("parts", 2))
    left = left.withColumn("part", every("parts")).drop("parts", "blocks")
    right = right.withColumn("block", every("blocks")).drop("parts", "blocks")
    return left, right


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The vectors of one length, in whole numbers."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else None
    values = np.zeros(0) if flat is None else flat.to_numpy(zero_copy_only=False)
    return np.floor(values.astype(np.float64) * SCALE).reshape(len(column), -1)


def _tiles(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[np.ndarray, slice]]:
    """Scores of all anchors with each run of rows."""
    factor, vectors = Factor(_matrix(anchors["vector"])), _matrix(rows["vector"])
    step = max(TILE // len(anchors), 1)
    for start in range(0, len(rows), step):
        run = slice(start, start + step)
        yield products(factor, vectors[run]), run


class Best:
    """For each of several anchors the best rows met so far, in order of score and then of place.

    Rows come in the order of their ids, so that a later row never beats an equal score.
    """

    def __init__(self, anchors: int, most: int):
        self.scores = np.full((anchors, most), _LOW)
        self.places = np.full((anchors, most), -1)

    def add(self, scores: np.ndarray, start: int) -> None:
        """Scores of a further run of rows, the lowest number where one does not count."""
        most = self.scores.shape[1]
        least = self.scores[:, -1]
        unfilled = np.flatnonzero(least == _LOW)
        if scores.shape[1] > 4 * most and len(unfilled):
            # Of these only scores among the run's best can get in.
            at = scores.shape[1] - most
            among = np.partition(scores[unfilled], at, axis=1)[:, at]
            least = least.copy()
            least[unfilled] = np.maximum(among, _LOW + 1) - 1
        anchor, row = np.nonzero(scores > least[:, None])
        if not len(anchor):
            return
        found = scores[anchor, row]
        some, rank_of = np.unique(anchor, return_inverse=True)
        anchor = np.concatenate([np.repeat(np.arange(len(some)), most), rank_of])
        found = np.concatenate([self.scores[some].ravel(), found])
        place = np.concatenate([self.places[some].ravel(), row + start])
        # Stable, so that of equal scores the earlier place comes first.
        order = np.lexsort((-found, anchor))
        anchor, found, place = anchor[order], found[order], place[order]
        rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
        kept = rank < most
        self.scores[some] = found[kept].reshape(-1, most)
        self.places[some] = place[kept].reshape(-1, most)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, place and score of all that are kept."""
        anchor, rank = np.nonzero(self.places >= 0)
        return anchor, self.places[anchor, rank], self.scores[anchor, rank]


Mine = Callable[[pa.Table, pa.Table], pa.Table]


def _met(left: DataFrame, right: DataFrame, keys: list[str], mine: Mine, schema: str) -> DataFrame:
    """What mine gives for the anchors and the rows, in order of ids, of each pair of blocks."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(anchors) or not len(rows):
            return empty
        return mine(anchors, rows.sort_by([("vec_id", "ascending"), ("row", "ascending")]))

    names = [field.split()[0] for field in schema.split(", ")]
    empty = pa.table({n: pa.array([], pa.int64()) for n in names})
    pairs = [*keys, "block", "part"]
    left = left.toDF(*left.columns)  # both sides come from one table
    return left.groupBy(*pairs).cogroup(right.groupBy(*pairs)).applyInArrow(run, schema)


def _first(rows: DataFrame, of: list[str], score: str, ties: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc(score), *ties)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def positives(rows: DataFrame, anchors: DataFrame, most: int) -> DataFrame:
    """anchor (its row), positive_id, positive_score and rank: the best rows of its label."""

    def mine(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        own, numbers = anchors["row"].to_numpy(), rows["row"].to_numpy()
        best = Best(len(anchors), most)
        for scores, run in _tiles(anchors, rows):
            scores[own[:, None] == numbers[run][None, :]] = _LOW
            best.add(scores, run.start)
        anchor, place, score = best.found()
        ids = rows["vec_id"].to_numpy()[place]
        return pa.table(
            {"anchor": own[anchor], "row": numbers[place], "vec_id": ids, "score": score}
        )

    keys = ["size", "label"]
    left, right = _dealt(rows, anchors, keys)
    met = _met(left, right, keys, mine, "anchor long, row long, vec_id long, score long")
    first = _first(met, ["anchor"], "score", ["vec_id", "row"], most)
    return first.select(
        "anchor",
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.col("rank").alias("positive_rank"),
    )


def window_of(positive_score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score from 50 to 95 percent of each; no product overflows."""
    return -(-positive_score // 2), positive_score - -(-positive_score // 20)


def negatives(rows: DataFrame, anchors: DataFrame, most: int) -> DataFrame:
    """anchor, positive_score, vec_id, score and rank: the best rows within each window.

    anchors have scores, those of their positives.
    """

    def mine(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        own, numbers = anchors["row"].to_numpy(), rows["row"].to_numpy()
        own_label, labels = anchors["label"].to_numpy(), rows["label"].to_numpy()
        wanted = anchors["scores"].to_pylist()
        width = max(map(len, wanted), default=0)
        # A window without scores for anchors of fewer positives.
        windows = np.full((2, width, len(own)), 1)
        windows[1] = 0
        for i, scores in enumerate(wanted):
            windows[:, : len(scores), i] = window_of(np.array(scores, np.int64))
        best = [Best(len(own), most) for _ in range(width)]
        for scores, run in _tiles(anchors, rows):
            other = own_label[:, None] != labels[run][None, :]
            for (low, high), kept in zip(windows.transpose(1, 0, 2), best, strict=True):
                # Only what beats the scores kept so far needs a look.
                low = np.maximum(low, np.maximum(kept.scores[:, -1], _LOW + 1))
                inside = (scores <= high[:, None]) & (scores >= low[:, None]) & other
                if inside.any():
                    kept.add(np.where(inside, scores, _LOW), run.start)
        ids, columns = rows["vec_id"].to_numpy(), []
        for at, kept in enumerate(best):
            anchor, place, score = kept.found()
            of = np.array([wanted[i][at] for i in anchor.tolist()], np.int64)
            columns.append((own[anchor], of, numbers[place], ids[place], score))
        names = ("anchor", "positive_score", "row", "vec_id", "score")
        joined = [np.concatenate(c) for c in zip(*columns, strict=True)] or [np.zeros(0, np.int64)] * 5
        return pa.table(dict(zip(names, joined, strict=True)))

    left, right = _dealt(rows, anchors, ["size"])
    schema = "anchor long, positive_score long, row long, vec_id long, score long"
    met = _met(left, right, ["size"], mine, schema)
    return _first(met, ["anchor", "positive_score"], "score", ["vec_id", "row"], most)


def hard_negatives(
    embeddings: DataFrame,
    anchor_every: int = 50,
    positive_count: int = POSITIVES,
    negative_count: int = NEGATIVES,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score and positive_rank."""
    rows = relabelled(usable(embeddings, id_col, label_col, vector_col))
    rows = rows.withColumn("size", F.size("vector")).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "vectors")
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    best = stored(positives(rows, anchors, positive_count), "positives")
    scores = best.groupBy("anchor").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    wanting = anchors.join(scores.withColumnRenamed("anchor", "row"), "row")
    found = negatives(rows, wanting, negative_count)
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        best.join(found, ["anchor", "positive_score"])
        .join(ids, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
            F.col("positive_rank").cast("int").alias("positive_rank"),
        )
    )
