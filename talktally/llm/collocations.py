"""Collocations of each language, mined by SON partitioning and counted exactly.

Documents are dealt by a hash into a few shards. A phrase that is frequent in a language is
frequent in at least one shard at the support lowered to the shard's part of the language's
words, rounded up: below it in all shards, its counts would add up to less than the support.
Each shard is mined completely at that support, level by level: words, then pairs of its
frequent words, then runs of three and four words all of whose pairs are frequent. The union
of what is frequent in any shard is then counted over all documents, by the phrases themselves.

Shards are a unit of the method and not of the work, which Spark spreads over tasks of any
number: a shard's counts are sums over all tasks that read a part of it. A support of 30 can
be lowered to few shards only; in more than 30 any phrase that occurs would be frequent.

While mining, phrases go by 64-bit hashes, and what is frequent by the bits of a filter, which
alone is broadcast and has a stated size at most. Hashes and bits that fall together only let
more candidates pass, never fewer, and the final counts go by the phrases themselves.

Words, pieces and phrases are as mining_words has them. A null text is empty and a null
language the one named in the parameters. Rows without words add nothing; repeated rows and
those without an id count like any other. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talktally.llm.frames import stored, trimmed, utf8
from talktally.llm.mining_words import LONGEST, phrases_of, texts_of, word_blocks

SUPPORT = 30
SHARDS = 4
EACH = 16  # bits of a filter for each phrase that it holds
MOST_FILTER_BITS = 30  # a filter has 2**30 bits at most, 128 MB
CHUNK_BITS = 18
SCALE = 2_000_000
SUBSUMED = 80  # percent
TOP = 2000
PARTS = 64


@dataclass(frozen=True)
class Mining:
    """support is a phrase's least count in all documents of a language."""

    support: int = SUPPORT
    shards: int = SHARDS
    most_filter_bits: int = MOST_FILTER_BITS


def dealt(
    documents: DataFrame, mining: Mining, id_col: str, text_col: str, lang_col: str, unnamed: str
) -> DataFrame:
    """text, lang and shard of each row, and their hashes: slot, and of the language alone whole."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(unnamed)).alias("lang")
    shard = F.pmod(F.xxhash64(id_col), F.lit(mining.shards)).cast("int").alias("shard")
    rows = documents.select(text, lang, shard)
    return rows.withColumns({"slot": F.xxhash64("lang", "shard"), "whole": F.xxhash64("lang")})


@dataclass(frozen=True)
class Filter:
    """A set of hashes of which one may be in by chance, but none is missing.

    data has 2**bits bits; a hash, told apart by what it is `of`, has the number of one.
    """

    data: bytes
    bits: int

    def has(self, hashes: np.ndarray, of: np.int64) -> np.ndarray:
        at = (hashes.view(np.int64) ^ of) & ((1 << self.bits) - 1)
        held = np.frombuffer(self.data, np.uint8)[at >> 3]
        return (held >> (at & 7).astype(np.uint8)) & 1 > 0


def filter_of(rows: DataFrame, of: str, most_bits: int) -> Filter:
    """The filter of the hashes of a stored table; the driver takes its bits and no rows.

    With more rows than it has room for more hashes are in by chance.
    """
    bits = min(max((EACH * rows.count()).bit_length(), 8), most_bits)
    chunk_bits = min(CHUNK_BITS, bits)
    names = ["chunk", "packed"]

    def told(chunk: int, own: np.ndarray) -> pa.RecordBatch:
        packed = np.packbits(own, bitorder="little").tobytes()
        arrays = [pa.array([chunk], pa.int64()), pa.array([packed], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, np.zeros(1 << chunk_bits, bool)
        for batch in batches:
            numbers, at = (batch.column(i).to_numpy() for i in (0, 1))
            for chunk in np.unique(numbers).tolist():
                if now is not None and chunk != now:
                    yield told(now, own)
                    own[:] = False
                now = chunk
                own[at[numbers == chunk] & ((1 << chunk_bits) - 1)] = True
        if now is not None:
            yield told(now, own)

    bit = F.col("hash").bitwiseXOR(F.col(of)).bitwiseAND(F.lit((1 << bits) - 1)).alias("bit")
    dealt = rows.select(bit).distinct().select(F.shiftright("bit", chunk_bits).alias("chunk"), "bit")
    dealt = dealt.repartition("chunk").sortWithinPartitions("chunk")
    data = bytearray(1 << (bits - 3))
    each = 1 << (chunk_bits - 3)
    for row in dealt.mapInArrow(run, "chunk long, packed binary").collect():
        data[row["chunk"] * each : (row["chunk"] + 1) * each] = row["packed"]
    return Filter(bytes(data), bits)


def _local_counts(rows: DataFrame, lengths: range, known: Filter | None) -> DataFrame:
    """slot, hash and n of the phrases of those lengths in each shard.

    Of two words and more only those whose words, or pairs, the filter holds for the shard.
    """
    shared = None if known is None else rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared and shared.value
        for batch in batches:
            for slot, texts in texts_of(batch, "slot"):
                part = 1 if min(lengths) < 3 else 2
                hashes = []
                for block in word_blocks(*utf8(texts)):
                    fits = held and held.has(block.hashes(part), slot)
                    hashes += [phrases_of(block, n, fits, part).hashes for n in lengths]
                found, counts = np.unique(np.concatenate(hashes), return_counts=True)
                columns = [np.full(len(found), slot), found.view(np.int64), counts.astype(np.int64)]
                arrays = [pa.array(c) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["slot", "hash", "n"])

    found = rows.select("text", "slot").mapInArrow(trimmed(run), "slot long, hash long, n long")
    return found.groupBy("slot", "hash").agg(F.sum("n").alias("n"))


def supports(words: DataFrame, shards: DataFrame, support: int) -> DataFrame:
    """slot, whole, lang, n (the language's words) and least.

    least is the support in proportion to the shard's part of the words, rounded up.
    """
    each = words.groupBy("slot").agg(F.sum("n").alias("own")).join(shards, "slot")
    each = each.withColumn("n", F.sum("own").over(Window.partitionBy("lang")))
    least = F.expr(f"(own * {support} + n - 1) div n").alias("least")
    return each.select("slot", "whole", "lang", "n", least)


def candidates(rows: DataFrame, words: DataFrame, least: DataFrame, most_bits: int) -> Filter:
    """A filter of all phrases, by language, that are frequent in any shard; words has their counts."""
    counts, union = words, []
    for lengths in (range(1, 2), range(2, 3), range(3, LONGEST + 1)):
        if union:
            counts = _local_counts(rows, lengths, known)
        kept = counts.join(least.select("slot", "whole", "least"), "slot").where("n >= least")
        kept = stored(kept.select("slot", "whole", "hash"), "shard-frequent")
        union.append(kept.select("whole", "hash"))
        if lengths[-1] < LONGEST:
            known = filter_of(kept, "slot", most_bits)
    return filter_of(reduce(DataFrame.union, union), "whole", most_bits)


def _counted(rows: DataFrame, known: Filter, support: int) -> DataFrame:
    """whole, phrase and n of all phrases in the filter, over all documents."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for whole, texts in texts_of(batch, "whole"):
                for block in word_blocks(*utf8(texts)):
                    for size in range(1, LONGEST + 1):
                        found = phrases_of(block, size)
                        found = found.where(held.has(found.hashes, whole))
                        one, counts = found.distinct()
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(counts), whole)),
                                one.texts(block),
                                pa.array(counts.astype(np.int64)),
                            ],
                            names=["whole", "phrase", "n"],
                        )

    schema = "whole long, phrase string, n long"
    found = rows.select("text", "whole").mapInArrow(trimmed(run), schema)
    counted = found.groupBy("whole", "phrase").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= support)


def _cut(part: str) -> Column:
    """The first k words of a phrase, or the rest."""
    parts = F.split("phrase", " ")
    start, length = (F.lit(1), F.col("k")) if part == "first" else (F.col("k") + 1, F.col("size"))
    return F.array_join(F.slice(parts, start, length), " ")


def _scored(counted: DataFrame) -> DataFrame:
    """Each candidate at its cut of the lowest score, with a, l, r and score."""
    known = counted.select("lang", F.col("phrase").alias("part"), F.col("n").alias("found"))
    cuts = counted.withColumn("size", F.size(F.split("phrase", " "))).withColumnRenamed("n", "a")
    cuts = cuts.where("size > 1")
    cuts = cuts.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.withColumns({"first": _cut("first"), "rest": _cut("rest")})
    for part, name in (("first", "l"), ("rest", "r")):
        own = known.withColumnsRenamed({"part": part, "found": name})
        cuts = cuts.join(own, ["lang", part])
    # Exact in 38 digits, and a quotient is at most half of the scale.
    score = F.expr(f"cast(a as decimal(38,0)) * {SCALE} div (cast(l as decimal(38,0)) + r)")
    cuts = cuts.withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    return cuts.groupBy("lang", "words", "phrase", "size", "a").agg(lowest).select(
        "lang", "words", "phrase", "size", "a", "low.l", "low.r", "low.score"
    )


def _unsubsumed(scored: DataFrame, percent: int) -> DataFrame:
    """Candidates that are inside no longer one which has nearly all their occurrences."""
    longer = scored.where("size > 2").select(
        "lang",
        "a",
        F.split("phrase", " ").alias("parts"),
        "size",
        F.explode(F.expr("sequence(2, size - 1)")).alias("part"),
    )
    longer = longer.withColumn("at", F.explode(F.expr("sequence(1, size - part + 1)")))
    inside = F.array_join(F.slice("parts", F.col("at"), F.col("part")), " ").alias("phrase")
    most = longer.groupBy("lang", inside).agg(F.max("a").alias("most"))
    wide = [F.col(c).cast("decimal(38,0)") for c in ("most", "a")]
    subsumed = F.coalesce(wide[0] * 100 >= wide[1] * percent, F.lit(False))
    return scored.join(most, ["lang", "phrase"], "left").where(~subsumed)


def _ranked(rows: DataFrame, of: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def collocations(
    documents: DataFrame,
    mining: Mining | None = None,
    top: int = TOP,
    subsumed: int = SUBSUMED,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    unnamed: str = "und",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's first phrases by score."""
    mining = mining or Mining()
    rows = dealt(documents, mining, id_col, text_col, lang_col, unnamed)
    shards = rows.select("slot", "whole", "lang").distinct()
    words = stored(_local_counts(rows, range(1, 2), None), "shard-words")
    least = stored(supports(words, shards, mining.support), "shard-supports")
    counted = _counted(rows, candidates(rows, words, least, mining.most_filter_bits), mining.support)
    langs = least.select("whole", "lang", F.col("n").alias("words")).distinct()
    counted = stored(counted.join(langs, "whole").drop("whole"), "phrases")
    scored = stored(_scored(counted), "scored")
    left = _unsubsumed(scored, subsumed)
    # A language's first among its first in each of some parts, so that no task sorts it all.
    left = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    ranked = _ranked(_ranked(left, ["lang", "part"], top), ["lang"], top)
    n = F.col("words").alias("n")
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", n, "score"
    )
