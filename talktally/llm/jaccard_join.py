"""Near-duplicate texts by an exact metric-space join under the Jaccard distance.

A text is its set of word shingles; texts link when 100 * shared >= percent * united, so
when their distance is at most e = 1 - percent / 100.

Unrelated texts are all at distance 1 from each other, so whole texts as first pivots
would tell nothing apart and every text would lie on every boundary. The first pivots are
therefore single shingles in one global order, the frequent ones last. A text's cell is
that of its first shingle, the nearest pivot; a text within e of it lacks only a bounded
part of its shingles, so it is replicated to the cells of its first n - ceil(n * percent
/ 100) + l shingles (its window), and two linked texts meet in at least l cells. Texts
that share too few cells with any other are done. Of the rest, each leaves its l - 1
largest cells, as a link is still met in another one.

Within a cell, whole texts are pivots: every member's distance to them is computed, links
join components, and cells of one component are done. Small cells compare what is left.
Large ones part into balls and a rest: by the triangle inequality a text within e of a
pivot links only to texts within 2e of that pivot, and texts beyond e of all pivots meet
in the rest. These join in the same way, without the pivots, until none is left.

Texts with equal sets are one class throughout. Sets are compared by 64-bit hashes of
their shingles. A text of fewer words than a shingle is one shingle; null texts and those
without words have an empty set and link with nothing. Rows of equal id count as one
document. A text without an id takes part in links like any other; a null id is never a
component's name unless no other is there. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talktally.llm.components import components
from talktally.llm.frames import id_and_text, stored, trimmed
from talktally.llm.shingles import WORDS, Sets, overlap, shingle_sets

PERCENT = 75
SLACK = 32  # l is a set's size by this
SMALL = 48  # members of a cell that are compared without pivots
PIVOTS = 8
HASH_RANGE = 1 << 30
BLOCK_SHINGLES = 100_000
SAMPLE_OF = 64  # the global order puts last what is frequent in one text of so many
MOST_FREQUENT = 50_000  # shingles that are put last; this changes cost, never results


def set_names(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and a hash of each text's set; 0 and 0 for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sets in shingle_sets(batch.column(1), words):
                ids = batch.column(0).slice(sets.first, sets.last - sets.first)
                columns = [ids, pa.array(np.diff(sets.ends)), pa.array(sets.names.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "name"])

    return documents.mapInArrow(trimmed(run), "doc_id long, n_shingles long, name long")


def frequent_shingles(documents: DataFrame, words: int = WORDS) -> np.ndarray:
    """Hashes of shingles that several sampled texts hold, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sets in shingle_sets(batch.column(1), words):
                atoms = pa.array(sets.atoms.view(np.int64))
                yield pa.RecordBatch.from_arrays([atoms], names=["atom"])

    sample = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_OF)) == 0)
    counted = sample.mapInArrow(trimmed(run), "atom long").groupBy("atom").count().where("count >= 4")
    most = counted.orderBy(F.desc("count"), "atom").limit(MOST_FREQUENT).select("atom")
    found = np.array([r[0] for r in most.collect()], np.int64).view(np.uint64)
    return np.sort(found)


def _needed(size, percent: int):
    return -(-size * percent // 100)


def _window(sets: Sets, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Places of the shingles that each set is replicated to."""
    row, size = sets.row(), np.diff(sets.ends)
    late = np.zeros(len(sets.atoms), bool)
    if len(frequent):
        at = np.searchsorted(frequent, sets.atoms)
        late = frequent[np.minimum(at, len(frequent) - 1)] == sets.atoms
    order = np.lexsort((sets.atoms, late, row))
    width = size - _needed(size, percent) + np.maximum(size // SLACK, 1)
    rank = np.arange(len(order)) - np.repeat(sets.ends[:-1], size)
    return order[rank < np.repeat(width, size)]


def cells(documents: DataFrame, frequent: np.ndarray, percent: int, words: int) -> DataFrame:
    """cell and name for each cell that a set is replicated to; may repeat."""
    late = documents.sparkSession.sparkContext.broadcast(frequent.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(late.value, np.uint64)
        for batch in batches:
            for sets in shingle_sets(batch.column(1), words):
                kept = _window(sets, frequent, percent)
                # Copies of a set within a block need not be told twice.
                _, first = np.unique(sets.names, return_index=True)
                row = sets.row()[kept]
                kept = kept[np.isin(row, first)]
                names = sets.names[sets.row()[kept]].view(np.int64)
                atoms = sets.atoms[kept].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(atoms), pa.array(names)], names=["cell", "name"]
                )

    return documents.mapInArrow(trimmed(run), "cell long, name long")


def _least_shared(size: Column, percent: int) -> Column:
    """In how many cells at least a set meets any other that it links with."""
    return F.greatest(F.floor(F.ceil(size * percent / 100) / SLACK), F.lit(1))


def _meeting(found: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """cell, name and size of sets that share enough cells, without each one's largest cells."""
    together = Window.partitionBy("cell")
    shared = (
        found.repartition("cell")
        .dropDuplicates(["cell", "name"])
        .withColumn("low", F.min("name").over(together))
        .withColumn("high", F.max("name").over(together))
        .where("low <> high")
        .select("cell", "name")
    )
    shared = stored(shared, "cells")
    sizes = classes.select("name", "size")
    enough = (
        shared.groupBy("name")
        .count()
        .join(sizes, "name")
        .where(F.col("count") >= _least_shared(F.col("size"), percent))
        .select("name", "size")
    )
    left = shared.join(enough, "name")
    members = left.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1")
    largest = Window.partitionBy("name").orderBy(F.desc("members"), F.desc("cell"))
    kept = (
        left.join(members, "cell")
        .withColumn("rank", F.row_number().over(largest))
        .where(F.col("rank") >= _least_shared(F.col("size"), percent))
    )
    return stored(kept.select("cell", "name", "size"), "cells")


def _texts_without_id(documents: DataFrame, words: int) -> DataFrame:
    """name and one text of each set that documents without an id have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sets in shingle_sets(batch.column(0), words):
                texts = batch.column(0).slice(sets.first, sets.last - sets.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.names.view(np.int64)), texts], names=["name", "text"]
                )

    texts = documents.where("doc_id is null").select("text").distinct()
    named = texts.mapInArrow(trimmed(run), "name long, text string")
    return named.groupBy("name").agg(F.min("text").alias("text"))


def class_sets(documents: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """name and atoms of the wanted classes, from the text of one document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(1).to_numpy().view(np.uint64)
            for sets in shingle_sets(batch.column(0), words):
                # Another text with the same id may have come along.
                own = np.flatnonzero(sets.names == names[sets.first : sets.last])
                atoms = [sets.atoms[sets.ends[i] : sets.ends[i + 1]].tobytes() for i in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.names[own].view(np.int64)), pa.array(atoms, pa.binary())],
                    names=["name", "atoms"],
                )

    chosen = wanted.select(F.col("rep").alias("doc_id"), "name")
    texts = documents.join(chosen, "doc_id").dropDuplicates(["doc_id", "name", "text"])
    # A class of which no document has an id is found by its name.
    unnamed = _texts_without_id(documents, words).join(chosen.where("doc_id is null"), "name")
    texts = texts.select("text", "name").union(unnamed.select("text", "name"))
    return texts.mapInArrow(trimmed(run), "name long, atoms binary")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, shared and united for pairs of classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (
                [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(i)] for i in (2, 3)
            )
            shared = [overlap(x, y) for x, y in zip(first, second, strict=True)]
            united = [
                len(x) + len(y) - s for x, y, s in zip(first, second, shared, strict=True)
            ]
            columns = [*batch.columns[:2], pa.array(shared, pa.int64()), pa.array(united, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "shared", "united"])

    both = pairs.join(sets.toDF("a", "atoms_a"), "a").join(sets.toDF("b", "atoms_b"), "b")
    both = both.select("a", "b", "atoms_a", "atoms_b")
    return both.mapInArrow(trimmed(run), "a long, b long, shared long, united long")


def _pair(x: str, y: str, percent: int) -> list[Column]:
    """The smaller and the larger name, and whether the sizes allow that likeness."""
    sizes = F.col(f"{x}.size"), F.col(f"{y}.size")
    names = F.col(f"{x}.name"), F.col(f"{y}.name")
    fits = F.least(*sizes) * 100 >= F.greatest(*sizes) * percent
    return [F.least(*names).alias("a"), F.greatest(*names).alias("b"), fits.alias("fits")]


def _block_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Members of cells in blocks of similar size, for each two blocks that may link.

    The blocks of a cell hold a bounded number of shingles; two are left out if their
    sizes are too far apart, or if all their members are of one component.
    """
    # Of cells with the same members one is enough.
    same = members.groupBy("cell").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("name").cast("decimal(38,0)")).alias("sum")
    )
    members = members.join(same.dropDuplicates(["n", "sum"]).select("cell"), "cell")
    by_size = Window.partitionBy("cell").orderBy("size", "name")
    before = F.sum("size").over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    block = F.floor(F.coalesce(before, F.lit(0)) / BLOCK_SHINGLES).alias("block")
    dealt = members.select("*", block)
    blocks = dealt.groupBy("cell", "block").agg(
        *(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("size", "component"))
    )
    x, y = blocks.alias("x"), blocks.alias("y")
    two = (
        x.join(y, "cell")
        .where("x.block <= y.block")
        .where(F.col("x.max_size") * 100 >= F.col("y.min_size") * percent)
        .where(
            "least(x.min_component, y.min_component) < greatest(x.max_component, y.max_component)"
        )
        .select("cell", F.col("x.block").alias("one"), F.col("y.block").alias("two"))
    )
    sides = two.select(
        F.xxhash64("cell", "one", "two").alias("pair"),
        "cell",
        F.explode(F.array_distinct(F.array("one", "two"))).alias("block"),
    )
    return sides.join(dealt, ["cell", "block"]).select("pair", "name", "component")


def _joined_blocks(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links a, b that join the components which members of each pair of blocks link."""

    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["atoms"].combine_chunks()]
        names, group = table["name"].to_numpy(), table["component"].to_pylist()
        size = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        _, which = np.unique(np.concatenate(sets), return_inverse=True)
        holders = owner[np.argsort(which, kind="stable")]
        held = np.bincount(which)
        begins, ends = np.cumsum(held) - held, np.cumsum(size)
        root = {c: c for c in group}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        a, b = [], []
        # The members of the commonest component need no comparing with each other.
        common = Counter(sorted(group)).most_common(1)[0][0]
        for i in sorted((i for i in range(len(sets)) if group[i] != common), key=lambda i: names[i]):
            own = which[ends[i] - size[i] : ends[i]]
            at = np.repeat(begins[own] - np.cumsum(held[own]) + held[own], held[own])
            shared = np.bincount(holders[at + np.arange(len(at))], minlength=len(sets))
            near = shared * 100 >= (size[i] + size - shared) * percent
            for j in np.flatnonzero(near).tolist():
                one, two = top(group[i]), top(group[j])
                if one != two:
                    root[max(one, two)] = min(one, two)
                    a.append(names[i])
                    b.append(names[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    both = pairs.dropDuplicates(["pair", "name"]).join(sets, "name")
    return both.groupBy("pair").applyInArrow(run, "a long, b long")


def _parted(large: DataFrame, close: DataFrame, percent: int, level: int) -> DataFrame:
    """Members of cells by the part that they go to: balls around pivots, and a rest.

    close has, for pivots of each cell, the members within 2e and what they share. A ball
    is needed only where another member than its pivot is within e of it.
    """
    core = F.col("shared") * 100 >= F.col("united") * percent
    others = large.where("not is_pivot").select("cell", "name", "size")
    near = others.join(close.withColumn("core", core), ["cell", "name"])
    with_core = near.where("core").select("cell", "pivot").distinct()
    balls = near.join(with_core, ["cell", "pivot"]).select(
        "cell", "name", "size", F.xxhash64("cell", "pivot").alias("part")
    )
    inner = near.where("core").select("cell", "name").distinct()
    rest = others.join(inner, ["cell", "name"], "left_anti").select(
        "cell", "name", "size", F.xxhash64("cell", F.lit(level)).alias("part")
    )
    return balls.union(rest).distinct()


def _divided(parts: DataFrame) -> DataFrame:
    """Cells whose parts are much smaller than they and not much more members in all."""
    sizes = parts.groupBy("cell", "part").agg(F.count("*").alias("members"))
    return (
        sizes.groupBy("cell")
        .agg(F.max("members").alias("most"), F.sum("members").alias("all"))
        .join(parts.groupBy("cell").agg(F.count_distinct("name").alias("had")), "cell")
        .where("most <= 0.7 * had and all <= 1.25 * had")
        .select("cell")
    )


def links_of_cells(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links a, b that join the same components as all links within cells would."""
    near = 2 * percent - 100  # percent of likeness at distance 2e
    checked: list[DataFrame] = []  # measured pairs of classes
    joined: list[DataFrame] = []  # links found in blocks

    def links() -> DataFrame:
        found = reduce(DataFrame.union, checked)
        found = found.where(F.col("shared") * 100 >= F.col("united") * percent).select("a", "b")
        return reduce(DataFrame.union, joined, found)

    def check(pairs: DataFrame) -> None:
        new = pairs.select("a", "b").where("a <> b").distinct()
        if checked:
            known = reduce(DataFrame.union, checked).select("a", "b")
            new = new.join(known, ["a", "b"], "left_anti")
        checked.append(stored(_measured(new, sets), "pairs"))

    # First, every member against the first of its cell, which most copies are close to.
    first = members.groupBy("cell").agg(F.min(F.struct("name", "size")).alias("p"))
    first = first.select("cell", "p.*")
    stars = members.alias("m").join(first.alias("p"), "cell")
    check(stars.select(*_pair("m", "p", percent)).where("fits"))
    members = members.join(first.select("cell", "name"), ["cell", "name"], "left_anti")
    for level in count(1):
        known = components(links()).toDF("name", "component")
        named = members.join(known, "name", "left").select(
            "cell", "name", "size", F.coalesce("component", "name").alias("component")
        )
        open_cells = (
            named.groupBy("cell")
            .agg(
                F.count("*").alias("members"),
                F.min("component").alias("low"),
                F.max("component").alias("high"),
                F.min(F.struct(F.xxhash64("name", F.lit(level)), "name"))["name"].alias("one"),
            )
            .where("low <> high")
            .select("cell", "members", "one")
        )
        left = stored(named.join(open_cells, "cell"), "members")
        small = left.where(F.col("members") <= SMALL)
        pairs = (
            small.alias("x")
            .join(small.alias("y"), "cell")
            .where("x.name < y.name and x.component <> y.component")
            .select(*_pair("x", "y", percent))
            .where("fits")
            .select("a", "b")
        )
        large = left.where(F.col("members") > SMALL)
        if large.isEmpty():
            check(pairs)
            return links()
        # The same sets are pivots in all cells of like size, so that pairs repeat.
        drawn = F.pmod(F.xxhash64("name", F.lit(level)), F.lit(HASH_RANGE))
        chance = drawn * F.col("members") < PIVOTS * HASH_RANGE
        large = large.withColumn("is_pivot", chance | (F.col("name") == F.col("one")))
        to_pivot = (
            large.alias("x")
            .join(large.where("is_pivot").alias("y"), "cell")
            .select(
                "cell",
                F.col("x.name").alias("name"),
                F.col("y.name").alias("pivot"),
                *_pair("x", "y", near),
            )
            .where("fits and a <> b")
            .drop("fits")
        )
        check(pairs.union(to_pivot.select("a", "b")))
        close = to_pivot.join(reduce(DataFrame.union, checked), ["a", "b"])
        close = close.where(F.col("shared") * 100 >= F.col("united") * near).drop("a", "b")
        parts = stored(_parted(large, close, percent, level), "parts")
        divided = stored(_divided(parts), "divided")
        # What pivots can't divide is compared in blocks, and closed with that.
        dense = large.where("not is_pivot").join(divided, "cell", "left_anti")
        blocks = _block_pairs(dense.select("cell", "name", "size", "component"), percent)
        joined.append(stored(_joined_blocks(blocks, sets, percent), "block-links"))
        members = parts.join(divided, "cell").select(F.col("part").alias("cell"), "name", "size")


def near_duplicates(
    documents: DataFrame,
    percent: int = PERCENT,
    words: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id reachable by links, of each row."""
    texts = id_and_text(documents, id_col, text_col)
    named = stored(set_names(texts, words), "sets")
    classes = (
        named.where("n_shingles > 0")
        .groupBy("name")
        .agg(F.max("n_shingles").alias("size"), F.min("doc_id").alias("rep"))
    )
    classes = stored(classes, "classes")
    found = cells(texts, frequent_shingles(texts, words), percent, words)
    members = _meeting(found, classes, percent)
    wanted = classes.join(members.select("name").distinct(), "name", "left_semi")
    sets = stored(class_sets(texts, wanted, words), "class-sets")
    linked = components(links_of_cells(members, sets, percent)).toDF("name", "component")
    by_class = classes.join(linked, "name", "left").select(
        "name", "rep", F.coalesce("component", "name").alias("component")
    )
    smallest = by_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    ids = by_class.join(smallest, "component").select("name", "component_id")
    empty = F.col("n_shingles") == 0
    return (
        named.withColumn("name", F.when(~empty, F.col("name")))
        .join(ids, "name", "left")
        .withColumn("component_id", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id")
    )
