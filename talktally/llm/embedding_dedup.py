"""Near-duplicate embeddings by lattice hashing, verified by cosine.

In each of several tables random orthogonal directions take a vector of unit length to
some blocks of eight numbers, and each block to its nearest point of the lattice E8; the
points together are the vector's cell. A vector is a member of its own cell and of some
neighbouring ones, those whose points are nearest. Two vectors are compared where they
first meet as members of one cell, in double precision. Cells are dealt in blocks of
bounded size; a block pair gives for each vector how many links it found, and a spanning
forest of the links, never the pairs.

Equal vectors are one class throughout. Vectors of each length have a lattice of their own
and link among themselves. Vectors that are null, empty, zero, or hold null or non-finite
numbers link with nothing, as do rows without an id, which have a null component. Repeated rows of one id count as vectors of
their own that share a component. An empty table gives no rows. Other columns of the
input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talktally.llm import e8
from talktally.llm.components import components
from talktally.llm.frames import stored

COSINE = 0.95
BLOCK_ROWS = 512


@dataclass(frozen=True)
class Lattice:
    """Tables of cells; more blocks make smaller cells, more tables and probes more meetings.

    Tables of any size have cells of the same fineness, so that links are found alike; the
    cells of a larger table have more members, which are dealt in more blocks.
    """

    size: int
    blocks: int = 2
    tables: int = 6
    probes: int = 3
    scale: float = 5 / 8  # times the root of the size, lattice units for a unit vector
    seed: int = 11

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """For each vector and table, its own cell's number and those of probed ones."""
        width = 8 * self.blocks
        out = np.zeros((len(unit), self.tables, 1 + self.probes), np.int64)
        for table in range(self.tables):
            x = unit @ _directions(self.size, width, self.seed + table)
            x = x * (self.scale * math.sqrt(max(self.size, width)))
            out[:, table] = self._members(x, table)
        return out

    def _members(self, x: np.ndarray, table: int) -> np.ndarray:
        each, further, names = 1 + self.probes, [], []
        for block in range(self.blocks):
            part = x[:, 8 * block : 8 * block + 8]
            own = e8.nearest(part)
            near, more = e8.around(part, own, self.probes)
            points = np.concatenate([own[:, None, :], near], axis=1)
            names.append(_named(np.rint(points * 2).astype(np.int64), table, block))
            further.append(np.concatenate([np.zeros((len(x), 1)), more], axis=1))
        # A probed cell changes one block's point; of all those the nearest are taken.
        base = sum(n[:, 0] for n in names)
        cost = np.concatenate([f[:, 1:] for f in further], axis=1)
        moved = np.concatenate([base[:, None] - n[:, :1] + n[:, 1:] for n in names], axis=1)
        best = np.argsort(cost, axis=1, kind="stable")[:, : each - 1]
        return np.concatenate([base[:, None], np.take_along_axis(moved, best, axis=1)], axis=1)


@lru_cache(maxsize=96)  # tables of 16 lengths
def _directions(size: int, width: int, seed: int) -> np.ndarray:
    """Random orthogonal directions, as many as a table's blocks have numbers."""
    drawn = np.random.default_rng(seed).standard_normal((max(size, width), width))
    return np.linalg.qr(drawn)[0][:size]


@cache
def _factors(table: int, block: int) -> np.ndarray:
    drawn = np.random.default_rng([table, block]).integers(1 << 62, size=8)
    return drawn.astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _named(points: np.ndarray, table: int, block: int) -> np.ndarray:
    """A 64-bit number for each point; a cell's is the sum of its points'."""
    with np.errstate(over="ignore"):
        name = (points.astype(np.uint64) * _factors(table, block)).sum(axis=-1)
        name = name + np.uint64(table * 1_000_003 + block)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            name = (name ^ (name >> np.uint64(shift))) * np.uint64(by)
    return name.view(np.int64)


def first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of the first cell that is in both, by table and then by number."""
    found = np.zeros(len(a), np.int64)
    open_rows = np.ones(len(a), bool)
    for table in range(a.shape[1]):
        same = a[:, table, :, None] == b[:, table, None, :]
        here = np.where(same.any(axis=2), a[:, table], np.iinfo(np.int64).max).min(axis=1)
        met = open_rows & same.any(axis=(1, 2))
        found[met], open_rows[met] = here[met], False
    return found


def _linked(vectors: np.ndarray, sides: np.ndarray, two: bool, cosine: float) -> np.ndarray:
    """Which vectors of one block link, or which of two blocks across them."""
    apart = sides[:, None] != sides[None, :] if two else ~np.eye(len(sides), dtype=bool)
    return (vectors @ vectors.T >= cosine) & apart


def compared(
    cell: int,
    sides: np.ndarray,
    two: bool,
    vectors: np.ndarray,
    cells: np.ndarray,
    copies: np.ndarray,
    cosine: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Of one block, or of two: links of each vector found here, and the smallest row linked with it.

    sides are 0 for one block and also 1 for the other of two; pairs within a block are
    compared where the block is alone. Rows are in the order of their ids.
    """
    a, b = np.nonzero(np.triu(_linked(vectors, sides, two, cosine)))
    here = first_meeting(cells[a], cells[b]) == cell
    a, b = a[here], b[here]
    counts = np.bincount(a, copies[b], len(sides)) + np.bincount(b, copies[a], len(sides))
    least = np.arange(len(sides))
    while len(a):
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == least).all():
            break
        least = new
    return counts.astype(np.int64), least


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow of squares
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _usable(embeddings: DataFrame, vector_col: str, id_col: str) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    nonzero = F.exists("vector", lambda x: x != 0)
    good = F.col("vec_id").isNotNull() & finite & nonzero
    return rows.withColumn("good", F.coalesce(good, F.lit(False)))


def _memberships(classes: DataFrame, tables: int, probes: int) -> DataFrame:
    """size, cell and rep; cells of different sizes have nothing to do with each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 2000):
                part = batch.slice(start, 2000)
                sizes = part.column(0).to_numpy()
                for size in np.unique(sizes).tolist():
                    own = part.take(pa.array(np.flatnonzero(sizes == size)))
                    lattice = Lattice(size, tables=tables, probes=probes)
                    cells = lattice.cells(_unit(_vectors(own.column(2))))
                    each = cells.shape[1] * cells.shape[2]
                    lengths, ids = (np.repeat(own.column(i).to_numpy(), each) for i in (0, 1))
                    columns = [pa.array(c) for c in (lengths, cells.ravel(), ids)]
                    yield pa.RecordBatch.from_arrays(columns, names=["size", "cell", "rep"])

    rows = classes.select("size", "rep", "vector")
    return rows.mapInArrow(run, "size int, cell long, rep long")


def _found(members: DataFrame, tables: int, probes: int, cosine: float) -> DataFrame:
    """size, rep, links and least (a linked rep, or itself) from rows sorted by block pair."""
    names = ("size", "cell", "one", "two", "side", "rep", "copies")
    keys = names[:4]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole block pairs, however the rows were cut into batches."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            at_rows = np.column_stack([batch.column(i).to_numpy() for i in range(len(keys))])
            cuts = np.flatnonzero((at_rows[1:] != at_rows[:-1]).any(axis=1)) + 1
            if held and any(held[-1].column(i)[-1].as_py() != x for i, x in enumerate(at_rows[0])):
                cuts = np.concatenate([[0], cuts])
            at = 0
            for cut in cuts.tolist():
                yield pa.Table.from_batches([*held, batch.slice(at, cut - at)])
                held, at = [], cut
            held.append(batch.slice(at))
        if held:
            yield pa.Table.from_batches(held)

    def linked(table: pa.Table) -> tuple | None:
        """Of a block pair, the vectors that have a link; only these need their cells."""
        if len(table) < 2:
            return None
        table = table.combine_chunks()
        _, cell, one, two, sides, reps, copies = (table[n].to_numpy() for n in names)
        both = bool(one[0] != two[0])
        if both and sides.min() == sides.max():
            return None
        unit = _unit(_vectors(table["vector"].combine_chunks()))
        some = np.flatnonzero(_linked(unit, sides, both, cosine).any(axis=1))
        if not len(some):
            return None
        return cell[0], both, sides[some], reps[some], copies[some], unit[some]

    def told(waiting: list[tuple]) -> pa.RecordBatch:
        """Of block pairs of vectors of one length."""
        vectors = np.concatenate([w[-1] for w in waiting])
        lattice = Lattice(vectors.shape[1], tables=tables, probes=probes)
        cells = lattice.cells(vectors)
        columns, at = ([], [], []), 0
        for cell, two, sides, reps, copies, unit in waiting:
            own, at = cells[at : at + len(reps)], at + len(reps)
            counts, least = compared(cell, sides, two, unit, own, copies, cosine)
            shown = np.flatnonzero((counts > 0) | (least != np.arange(len(reps))))
            for column, values in zip(columns, (reps, counts, reps[least]), strict=True):
                column.append(values[shown])
        arrays = [pa.array(np.concatenate(c)) for c in columns]
        size = pa.array(np.full(len(arrays[0]), lattice.size, np.int32))
        return pa.RecordBatch.from_arrays([size, *arrays], names=["size", "rep", "links", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        rows = 0
        for table in groups(batches):
            if found := linked(table):
                if waiting and waiting[-1][-1].shape[1] != found[-1].shape[1]:
                    yield told(waiting)
                    waiting, rows = [], 0
                waiting.append(found)
                rows += len(found[-1])
            if rows >= 2000:
                yield told(waiting)
                waiting, rows = [], 0
        if waiting:
            yield told(waiting)

    dealt = members.select(*names, "vector").repartition(*keys)
    dealt = dealt.sortWithinPartitions(*keys, "side", "rep")
    return dealt.mapInArrow(run, "size int, rep long, links long, least long")


def linked_embeddings(
    embeddings: DataFrame,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    tables: int = 6,
    probes: int = 3,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = _usable(embeddings, vector_col, id_col)
    classes = rows.where("good").groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")
    )
    # Two classes of one id would be one node of the links' graph; ids name vectors.
    size = F.size("vector").alias("size")
    classes = stored(classes.select(size, "rep", "vector", "copies"), "vector-classes")
    meeting = stored(_memberships(classes, tables, probes), "memberships").distinct()
    parts = F.ceil(F.count("*") / block_rows).cast("int").alias("parts")
    shared = meeting.groupBy("size", "cell").agg(F.count("*").alias("members"), parts)
    shared = shared.where("members > 1")
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part")
    members = meeting.join(shared.drop("members"), ["size", "cell"]).select("*", part)
    # Each part with itself and with every other part of its cell.
    members = members.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "size",
        "cell",
        F.least("part", "other").alias("one"),
        F.greatest("part", "other").alias("two"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
        "rep",
    )
    members = members.join(classes, ["size", "rep"])
    found = stored(_found(members, tables, probes, cosine), "found")
    component = components(found, "rep", "least").toDF("rep", "component")
    counts = found.groupBy("size", "rep").agg(F.sum("links").alias("links"))
    told = (
        classes.join(counts, ["size", "rep"], "left")
        .join(component, "rep", "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    good = rows.where("good").join(told, "vector").select("vec_id", "links", "component")
    bad = rows.where("not good").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return good.union(bad).select(
        "vec_id",
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"),
    )
