"""Exact token counts; huge texts are encoded in overlapping chunks and spliced.

A chunk is encoded with offsets. Two neighbours are spliced at a place in their overlap
where a visible character is followed by white space, both encodings end a token there,
and neither chunk's edge is near. The byte-level pattern always cuts at such a place and
looks at nothing before it, so what follows is encoded alike in the chunk and in the
whole text, and what precedes was so from the last splice on. If an overlap has no such
place it is widened, at worst to the end of the text.

Null and empty texts count 0 tokens. Repeated rows each give a row. Other columns of the
input are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talktally.llm import bpe
from talktally.llm.frames import id_and_text, utf8

HUGE_CHARS = 1 << 16  # longer texts are spliced
CHUNK_CHARS = 1 << 14
OVERLAP_CHARS = 512
EDGE_CHARS = 32  # a splice keeps off the edges by more than the longest special string
LIMIT_TOKENS = 512

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _is_proven(text: str, at: int) -> bool:
    before = text[at - 1]
    return text[at] in " \n\t\r" and (before.isalnum() or "!" <= before <= "~")


def common_boundary(text: str, low: int, high: int, left: list[int], right: list[int]) -> int | None:
    """The proven place between low and high that is nearest their middle and in both lists.

    left and right are places where the two encodings end a token, in order.
    """
    ends = set(left[bisect_right(left, low - 1) :]).intersection(right)
    middle = (low + high) // 2
    places = (p for p in ends if low <= p < high and p < len(text) and _is_proven(text, p))
    return min(places, key=lambda p: (abs(p - middle), p), default=None)


def spliced_ids(
    text: str,
    encode_with_ends,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    edge: int = EDGE_CHARS,
) -> Iterator[list[int]]:
    """The ids of a text, part by part. encode_with_ends gives ids and each one's last place."""
    begin, stop = 0, min(chunk, len(text))
    ids, ends = encode_with_ends(text[begin:stop])
    done = 0  # ids of this chunk before the splice that begins it
    while stop < len(text):
        width, splice = min(overlap, max(chunk // 2, 1)), None
        next_begin = max(stop - width, begin)
        next_stop = min(stop + chunk - width, len(text))
        after, after_ends = encode_with_ends(text[next_begin:next_stop])
        while True:
            splice = common_boundary(
                text,
                next_begin + edge,
                stop - edge,
                [begin + e for e in ends],
                [next_begin + e for e in after_ends],
            )
            if splice is not None or stop == len(text):
                break
            # Widen: the left chunk reaches further into the right one, which grows too.
            width *= 2
            stop = min(stop + width, len(text))
            next_stop = min(max(next_stop, stop + chunk), len(text))
            ids, ends = encode_with_ends(text[begin:stop])
            after, after_ends = encode_with_ends(text[next_begin:next_stop])
        if splice is None:
            break  # the left chunk has come to hold the rest of the text
        yield ids[done : bisect_right(ends, splice - begin)]
        done = bisect_right(after_ends, splice - next_begin)
        begin, stop, ids, ends = next_begin, next_stop, after, after_ends
    yield ids[done:]


def _with_ends(file: str):
    tokenizer = bpe.tokenizer(file)

    def encode(text: str) -> tuple[list[int], list[int]]:
        found = tokenizer.encode(text, add_special_tokens=False)
        # An end is where the token's visible part ends, which never goes back.
        return found.ids, np.maximum.accumulate([0, *(e for _, e in found.offsets)])[1:].tolist()

    return encode


def counts_of(texts: pa.Array, file: str, huge: int = HUGE_CHARS, **chunks) -> np.ndarray:
    data, ends = utf8(texts)
    counts = np.zeros(len(texts), np.int64)
    # A text of that many characters has at least as many bytes.
    long_rows = np.flatnonzero(np.diff(ends) > huge)
    for i in long_rows:
        text = data[ends[i] : ends[i + 1]].tobytes().decode("utf-8")
        if len(text) > huge:
            counts[i] = sum(map(len, spliced_ids(text, _with_ends(file), **chunks)))
        else:
            counts[i] = len(bpe.tokenizer(file).encode(text, add_special_tokens=False).ids)
    keep = np.setdiff1d(np.arange(len(texts)), long_rows)
    data, ends = utf8(texts.take(pa.array(keep)))
    for block in bpe.unit_encoder(file).batches(data, ends):
        counts[keep[block.first : block.last]] = np.diff(block.ends)
    return counts


def token_counts(
    documents: DataFrame,
    tokenizer_file: str | None = None,
    limit: int = LIMIT_TOKENS,
    huge_chars: int = HUGE_CHARS,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """Bytes and tokens of every text: doc_id, n_bytes, n_tokens, over_limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = tokenizer_file or bpe.default_file()
        for batch in batches:
            texts = batch.column(1)
            _, ends = utf8(texts)
            counts = counts_of(
                texts, file, huge_chars, chunk=chunk_chars, overlap=overlap_chars
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends)), pa.array(counts), pa.array(counts > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return id_and_text(documents).mapInArrow(run, SCHEMA)
