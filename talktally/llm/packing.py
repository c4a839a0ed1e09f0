"""Best-fit packing of token pieces into sequences, by a grouping genetic algorithm.

Pieces are dealt by a hash into pools of bounded size. Each pool evolves on several
islands; between rounds each island's elite moves on to the next island of its pool.
Bins that still have room are then broken up, dealt anew among pools and evolved once
more, so that what one pool lacks another can give. See grouping_ga for the algorithm.

A null or empty text is its end token alone. Repeated rows are packed as rows of their
own. Equal lengths are interchangeable; which one goes where follows from the item
numbers. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talktally.llm import bpe
from talktally.llm.frames import id_and_text, stored, trimmed, utf8
from talktally.llm.grouping_ga import Bins, Effort, evolve

CAPACITY = 1024
END_ID = 2

PIECES = "doc_id long, piece int, start long, length long, ids binary"
STATE = "pool long, island int, items array<long>, lengths array<int>, population array<array<int>>"
PLACES = "item long, length long, sequence_id long, offset long, room long"


@dataclass(frozen=True)
class PackingPlan:
    """How the search is spread: pools of about pool_items, on islands, in rounds, in levels."""

    pool_items: int = 2000
    islands: int = 2
    rounds: int = 2
    levels: int = 2
    effort: Effort = Effort(population=6, generations=30)


def pieces(
    documents: DataFrame,
    tokenizer_file: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """The token ids of each text with its end token, cut where longer than a sequence.

    ids holds them as little-endian 32-bit numbers. The first piece is the short one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.unit_encoder(tokenizer_file or bpe.default_file())
        for batch in batches:
            doc_ids = batch.column(0)
            data, ends = utf8(batch.column(1))
            for block in encoder.batches(data, ends):
                # Each row's ids are followed by the end token.
                ids = np.insert(block.ids.astype("<u4"), block.ends[1:], end_id)
                begins = block.ends[:-1] + np.arange(len(block.ends) - 1)
                totals = np.diff(block.ends) + 1
                count = -(-totals // capacity)
                row = np.repeat(np.arange(len(totals)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = totals - (count - 1) * capacity
                start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[row])
                places = np.append((begins[row] + start) * 4, len(ids) * 4)
                raw = pa.Array.from_buffers(
                    pa.binary(),
                    len(row),
                    [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(ids)],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(block.first + row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        raw,
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return id_and_text(documents).mapInArrow(trimmed(run), PIECES)


def _to_bins(chromosome: list[int]) -> Bins:
    bins: dict[int, list[int]] = {}
    for item, at in enumerate(chromosome):
        bins.setdefault(at, []).append(item)
    return list(bins.values())


def _to_chromosome(bins: Bins, items: int) -> list[int]:
    chromosome = [0] * items
    for at, b in enumerate(bins):
        for item in b:
            chromosome[item] = at
    return chromosome


def _evolved(state: DataFrame, capacity: int, effort: Effort, round_no: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seed = (row["pool"] * 31 + row["island"]) * 31 + round_no
                bins = evolve(
                    row["lengths"],
                    capacity,
                    [_to_bins(c) for c in row["population"]],
                    seed,
                    effort,
                )
                row["population"] = [_to_chromosome(b, len(row["items"])) for b in bins]
                yield pa.RecordBatch.from_pylist([row], schema=batch.schema)

    return state.repartition("pool", "island").mapInArrow(trimmed(run), STATE)


def _migrated(state: DataFrame, islands: int) -> DataFrame:
    """Each island's population with the elite of the island before it."""
    guests = state.select(
        "pool",
        ((F.col("island") + 1) % islands).cast("int").alias("island"),
        F.col("population")[0].alias("guest"),
    )
    return state.join(guests, ["pool", "island"]).select(
        "pool",
        "island",
        "items",
        "lengths",
        F.array_union("population", F.array("guest")).alias("population"),
    )


def _places(state: DataFrame, capacity: int) -> DataFrame:
    """Of each pool the best packing, as one row for each item."""
    bins = F.size(F.array_distinct(F.col("population")[0]))
    best = state.groupBy("pool").agg(
        F.min_by(
            F.struct("items", "lengths", F.col("population")[0].alias("bins")),
            F.struct(bins, "island"),
        ).alias("best")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                items, lengths = row["items"], row["lengths"]
                out = []
                for members in _to_bins(row["bins"]):
                    offset, first = 0, min(items[m] for m in members)
                    room = capacity - sum(lengths[m] for m in members)
                    for m in members:
                        out.append((items[m], lengths[m], first, offset, room))
                        offset += lengths[m]
                names = ["item", "length", "sequence_id", "offset", "room"]
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return best.select("best.*").mapInArrow(trimmed(run), PLACES)


def placed(items: DataFrame, capacity: int = CAPACITY, plan: PackingPlan | None = None) -> DataFrame:
    """A sequence and an offset for each item: item, length, sequence_id, offset.

    items has a number of its own for each row (item) and a length from 1 to the capacity.
    A sequence is named by its smallest item.
    """
    plan = plan or PackingPlan()
    zero = F.lit(0).cast("long")
    whole = items.where(F.col("length") == capacity).select(
        "item", "length", F.col("item").alias("sequence_id"), zero.alias("offset")
    )
    rest = items.where(F.col("length") < capacity).select(
        "item", "length", F.col("item").alias("sequence_id")
    )
    done = [whole]
    for level in range(plan.levels):
        count = rest.count()
        if not count:
            break
        pools = -(-count // plan.pool_items)
        # Bins stay together at first; from the second level on they only fix the pool.
        pool = F.pmod(F.xxhash64("sequence_id", F.lit(level)), F.lit(pools))
        state = (
            rest.groupBy(pool.alias("pool"))
            .agg(F.sort_array(F.collect_list(F.struct("length", "item"))).alias("items"))
            .select(
                "pool",
                F.explode(F.sequence(F.lit(0), F.lit(plan.islands - 1))).alias("island"),
                F.col("items.item").alias("items"),
                F.col("items.length").cast("array<int>").alias("lengths"),
                F.array().cast("array<array<int>>").alias("population"),
            )
        )
        for round_no in range(plan.rounds):
            if round_no:
                state = _migrated(state, plan.islands)
            state = stored(_evolved(state, capacity, plan.effort, round_no), "packing-islands")
        places = stored(_places(state, capacity), "packing-places")
        last = level == plan.levels - 1
        done.append(places.where(F.lit(last) | (F.col("room") == 0)).drop("room"))
        rest = places.where(~F.lit(last) & (F.col("room") > 0)).select(
            "item", "length", "sequence_id"
        )
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def packed(
    items: DataFrame, capacity: int = CAPACITY, plan: PackingPlan | None = None
) -> DataFrame:
    """The rows of items, which have a length, with sequence_id and offset."""
    numbered = stored(items.withColumn("item", F.monotonically_increasing_id()), "packing-items")
    places = placed(numbered.select("item", "length"), capacity, plan).drop("length")
    return numbered.join(places, "item").drop("item")
