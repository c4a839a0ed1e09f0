"""Document fingerprints: homomorphic hashes of a text's multiset of paragraphs.

A paragraph, a line of the text, is hashed to a wide vector of 32-bit numbers, and a
text's fingerprint is the sum of its paragraphs' vectors modulo 2**32. So the order of
paragraphs does not matter, and one is inserted or deleted by adding or subtracting its
vector. The first part of a vector is drawn by an extendable hash function and tells
different multisets apart. The rest counts the paragraph's runs of three words, each with
a sign in a place, both by a hash; these sums keep angles, so that two fingerprints tell
how like their texts are.

A null or empty text has no paragraphs and the zero vector. Two texts without words are
alike (1) if their fingerprints are equal and unlike (0) if not. Repeated rows each give
a row; rows of equal id follow each other in the order of their texts, and null ids come
last. A single row is its own next one. An empty table gives no rows. Other columns of
the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talktally.llm.frames import id_and_text, utf8
from talktally.llm.words import WHITE, byte_table, mix, n_grams, words_of

LANES, PLACES, RUN = 32, 128, 3
BLOCK_ROWS = 8000
LOWEST = -(1 << 63)

_TABLE = byte_table(WHITE)
_TABLE[0x41:0x5B] -= 32  # case counts

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _lanes(paragraph: bytes) -> bytes:
    return hashlib.shake_128(paragraph).digest(4 * LANES)


def _paragraph_ends(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where paragraphs end, each with its line feed, and the row of each."""
    feeds = np.flatnonzero(data == 0x0A) + 1
    stops = np.concatenate([feeds, ends[1:][np.diff(ends) > 0]])
    kind = np.concatenate([np.zeros(len(feeds), np.int8), np.ones(len(stops) - len(feeds), np.int8)])
    order = np.lexsort((kind, stops))
    stops, kind = stops[order], kind[order]
    # A text that ends in a line feed has an empty paragraph after it.
    row = np.searchsorted(ends, stops, side="left") - 1
    return np.concatenate([[0], stops]), row


def fingerprints(texts: pa.Array) -> np.ndarray:
    """One row of LANES + PLACES 32-bit numbers for each text."""
    data, ends = utf8(texts)
    stops, row = _paragraph_ends(data, ends)
    out = np.zeros((len(texts), LANES + PLACES), np.uint32)
    if not len(row):
        return out
    raw = data.tobytes()
    drawn = [
        _lanes(raw[a:b].removesuffix(b"\n"))
        for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)
    ]
    lanes = np.frombuffer(b"".join(drawn), "<u4").reshape(-1, LANES)
    begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    with np.errstate(over="ignore"):
        out[row[begins], :LANES] = np.add.reduceat(lanes, begins, axis=0, dtype=np.uint32)
        counts = np.zeros(len(texts) * PLACES, np.int64)
        for block in words_of(data, stops, _TABLE):
            size = np.bincount(block.row, minlength=block.last - block.first)
            for n in range(1, RUN + 1):
                at, runs = n_grams(block, n)
                # Paragraphs of fewer words are one run.
                kept = size[at] == n if n < RUN else slice(None)
                at, runs = row[block.first + at[kept]], mix(runs[kept])
                place = (runs % np.uint64(PLACES)).astype(np.int64)
                sign = (runs >> np.uint64(63)).astype(np.int64) * 2 - 1
                np.add.at(counts, at * PLACES + place, sign)
        out[:, LANES:] = counts.reshape(-1, PLACES).astype(np.uint32)
    return out


def changed(
    fingerprint: np.ndarray, inserted: Iterable[str] = (), deleted: Iterable[str] = ()
) -> np.ndarray:
    """The fingerprint after some paragraphs are inserted and others deleted."""

    def total(paragraphs: Iterable[str]) -> np.ndarray:
        # A paragraph with a line feed at its end is hashed with an empty one after it.
        some = fingerprints(pa.array([p for p in paragraphs if p], pa.string()))
        blank = np.zeros(LANES + PLACES, np.uint32)
        blank[:LANES] = np.frombuffer(_lanes(b""), "<u4")
        blanks = sum(1 for p in paragraphs if not p)
        return some.sum(axis=0, dtype=np.uint32) + blank * np.uint32(blanks)

    inserted, deleted = list(inserted), list(deleted)
    with np.errstate(over="ignore"):
        return fingerprint + total(inserted) - total(deleted)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From 0 to 1 for each two fingerprints: the cosine of what they count, 1 if equal."""
    x, y = (f[:, LANES:].view(np.int32).astype(np.float64) for f in (a, b))
    product = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = (x * y).sum(axis=1) / np.where(product > 0, product, 1)
    return np.where((a == b).all(axis=1), 1.0, np.clip(cosine, 0.0, 1.0))


def as_text(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.astype("<u4").tobytes()).decode("ascii")


def edited(text: str, after: str) -> str:
    """The last half of a text replaced by as much of the next one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _with_next(texts: DataFrame, block_rows: int) -> DataFrame:
    """Rows in blocks of descending ids, each block with the row that follows its last.

    The last block is followed by the first row of all. Only the blocks' bounds come to
    the driver, a few bytes for each block_rows rows.
    """
    keyed = texts.withColumn("key", F.coalesce("doc_id", F.lit(LOWEST)))
    rows = keyed.count()
    if not rows:
        return keyed.select(F.lit(0).alias("block"), F.lit(0).alias("extra"), "*")
    blocks = -(-rows // block_rows)
    shares = [i / blocks for i in range(1, blocks)] or [0.5]
    accuracy = max(10_000, 20 * blocks)
    cuts = keyed.agg(F.percentile_approx("key", shares, accuracy)).first()[0]
    cuts = np.unique(np.array(cuts, np.int64)) if blocks > 1 else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def block_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), side="left").astype(np.int32))

    dealt = keyed.select("*", block_of("key").alias("block"))
    bounds = keyed.select("key", block_of("key").alias("block"))
    found = bounds.groupBy("block").agg(F.max("key").alias("top")).collect()
    tops = sorted(((r["top"], r["block"]) for r in found), reverse=True)
    after = [(tops[(i + 1) % len(tops)][0], block) for i, (_, block) in enumerate(tops)]
    extra = texts.sparkSession.createDataFrame(after, "key long, goes_to int")
    own = F.struct(F.col("block"), F.lit(0).alias("extra"))
    other = F.struct(F.col("goes_to").alias("block"), F.lit(1).alias("extra"))
    places = F.array_compact(F.array(own, F.when(F.col("goes_to").isNotNull(), other)))
    return (
        dealt.join(F.broadcast(extra), "key", "left")
        .withColumn("at", F.explode(places))
        .select("at.block", "at.extra", "doc_id", "key", "text")
        .repartitionById(len(cuts) + 1, "block")
        .sortWithinPartitions("block", "extra", F.desc("key"), "text")
    )


def document_fingerprints(documents: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like they are.

    The edited form takes its end from the next document in descending order of ids.
    """

    def told(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, each with the one after it; extra ones only follow."""
        texts = [r[3] for r in rows]
        own = fingerprints(pa.array(texts, pa.large_string()))
        kept = [i for i in range(len(rows) - 1) if not rows[i][1]]
        new = [edited(texts[i], texts[i + 1]) for i in kept]
        other = fingerprints(pa.array(new, pa.large_string()))
        after = [i + 1 for i in kept]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([rows[i][2] for i in kept], pa.int64()),
                "n_chars": pa.array([len(texts[i]) for i in kept], pa.int64()),
                "edited_sha256": pa.array(
                    [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in new], pa.string()
                ),
                "fingerprint": pa.array([as_text(own[i]) for i in kept], pa.string()),
                "edited_fingerprint": pa.array([as_text(f) for f in other], pa.string()),
                "near_edited": pa.array(likeness(own[kept], other)),
                "near_next": pa.array(likeness(own[kept], own[after])),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in batches:
            for start in range(0, len(batch), 500):
                columns = batch.slice(start, 500).to_pydict()
                names = ("block", "extra", "doc_id", "text")
                waiting += zip(*(columns[n] for n in names), strict=True)
                if len(waiting) > 1:
                    yield told(waiting)
                    waiting = waiting[-1:]

    texts = id_and_text(documents)
    return _with_next(texts, block_rows).drop("key").mapInArrow(run, SCHEMA)
