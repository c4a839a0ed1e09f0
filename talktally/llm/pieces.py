"""SentencePiece encoding and decoding by a unigram model over a double-array trie.

The pieces and their log scores come from a model file. The only one given,
piece_bpe_32k.model, is a BPE file: its scores are ranks of merges, which are summed here
as if they were log scores, so that ids are mostly not those that the library finds for
that file; they decode to the same text. Text is normalised as the file
says for this model: a space in front, then each space as the marker U+2581. Viterbi
search finds the pieces of the largest total score; a character that is in no piece
costs more than any piece and becomes the byte pieces of its UTF-8 form. No piece holds a
marker after another character, so that a text's best pieces are those of its units, a
run of markers and what follows up to the next; that is checked as the file is read.
Decoding joins pieces and bytes, turns markers to spaces and drops the one in front.

Null and empty texts have no pieces. A marker within a text counts as a space, and is
decoded as one. Repeated rows each give a row. An empty table gives no rows. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talktally.llm.frames import id_and_text, utf8
from talktally.llm.units import UnitEncoder

MARKER = "▁"
UNKNOWN_PENALTY = 10.0  # below the smallest score


class DoubleArrayTrie:
    """Byte strings to numbers. A node's child by a byte is at base + byte if check says so."""

    def __init__(self, keys: list[bytes], values: list[int]):
        tree: list[dict[int, int]] = [{}]
        number: dict[int, int] = {}
        for key, value in zip(keys, values, strict=True):
            at = 0
            for byte in key:
                if byte not in tree[at]:
                    tree.append({})
                    tree[at][byte] = len(tree) - 1
                at = tree[at][byte]
            number[at] = value
        size = 2 * len(tree) + 512
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        self.check[0] = 0
        place, free = {0: 0}, 1
        from_here = 1  # nodes of several children look for room from here on
        waiting = [0]
        for node in waiting:
            at = place[node]
            self.value[at] = number.get(node, -1)
            if not tree[node]:
                continue
            labels = sorted(tree[node])
            while self.check[free] >= 0:
                free += 1
            if len(labels) == 1:
                base = free - labels[0]
            else:
                base, tries = max(from_here, free) - labels[0], 0
                while base < 1 or any(self.check[base + byte] >= 0 for byte in labels):
                    base, tries = base + 1, tries + 1
                    self._grow(base + 512)
                if tries > 64:
                    from_here = max(from_here, base - 32)
            self.base[at] = base
            for byte in labels:
                self.check[base + byte] = at
                place[tree[node][byte]] = base + byte
                waiting.append(tree[node][byte])
            self._grow(base + 512)

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base += [0] * more
            self.check += [-1] * more
            self.value += [-1] * more


class UnigramModel:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, file: str):
        from sentencepiece import SentencePieceProcessor

        known = SentencePieceProcessor(model_file=file)
        ids = range(known.get_piece_size())
        self.texts = [known.id_to_piece(i) for i in ids]
        self.scores = [known.get_score(i) for i in ids]
        self.bytes = [known.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        normal = [
            i
            for i in ids
            if not (known.is_control(i) or known.is_unknown(i) or known.is_byte(i) or known.is_unused(i))
        ]
        if any(MARKER in self.texts[i].lstrip(MARKER) for i in normal):
            raise ValueError("a piece holds a marker after another character")
        if not all(known.is_byte(i) for i in self.bytes):
            raise ValueError("the model has no byte pieces")
        self.unknown = min(self.scores[i] for i in normal) - UNKNOWN_PENALTY
        self.trie = DoubleArrayTrie([self.texts[i].encode("utf-8") for i in normal], normal)
        # What each piece is decoded to.
        parts = [self.texts[i].replace(MARKER, " ").encode("utf-8") for i in ids]
        for i in ids:
            if known.is_control(i) or known.is_unknown(i):
                parts[i] = b""
        for byte, i in enumerate(self.bytes):
            parts[i] = bytes([byte])
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.decoded = np.frombuffer(b"".join(parts), np.uint8)

    def viterbi(self, text: str) -> list[int]:
        """The ids of the best pieces of a normalised text; of equal paths that with the
        earlier beginning of the last differing piece."""
        raw = text.encode("utf-8")
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        size = len(raw)
        best: list[float | None] = [None] * (size + 1)
        best[0] = 0.0
        source: list[tuple[int, int]] = [(0, 0)] * (size + 1)
        for start in range(size):
            score = best[start]
            if score is None:
                continue
            lead = raw[start]
            char = start + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            node, at, alone = 0, start, False
            while at < size:
                child = base[node] + raw[at]
                if check[child] != node or not child:
                    break
                node, at = child, at + 1
                piece = value[node]
                if piece >= 0:
                    alone = alone or at == char
                    total = score + scores[piece]
                    if best[at] is None or total > best[at]:
                        best[at], source[at] = total, (start, piece)
            if not alone:
                total = score + self.unknown
                if best[char] is None or total > best[char]:
                    best[char], source[char] = total, (start, -1)
        out: list[int] = []
        at = size
        while at:
            start, piece = source[at]
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.bytes[b] for b in reversed(raw[start:at])]
            at = start
        return out[::-1]

    def encode(self, units: list[str]) -> list[list[int]]:
        return [self.viterbi(u.replace(" ", MARKER)) for u in units]


def marker_starts(data: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Units begin at the first of a run of spaces, and at each text's beginning."""
    start = np.zeros(len(data) + 1, bool)
    start[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
    start[breaks] = True
    start[-1] = False
    return np.flatnonzero(start)


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@cache
def model(file: str) -> UnigramModel:
    return UnigramModel(file)


@cache
def unit_encoder(file: str) -> UnitEncoder:
    """One for each worker process, so that its tasks share what is known."""
    return UnitEncoder(model(file).encode, lambda text: [], (), marker_starts)


def normalised(texts: pa.Array) -> pa.Array:
    """Each text with a space in front, if it is not empty, and spaces for markers."""
    rows = (t.as_py() or "" for t in texts)
    return pa.array([f" {t.replace(MARKER, ' ')}" if t else "" for t in rows], pa.large_string())


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    places = pa.py_buffer(ends.astype(np.int32))
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, places, pa.py_buffer(np.ascontiguousarray(values))]
    )


def encoded(documents: DataFrame, model_file: str | None = None) -> DataFrame:
    """doc_id, text and ids, little-endian 32-bit numbers, of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(model_file or default_file())
        for batch in batches:
            data, ends = utf8(normalised(batch.column(1)))
            for block in encoder.batches(data, ends):
                part = batch.slice(block.first, block.last - block.first)
                ids = _binary(block.ids.astype("<u4"), block.ends * 4)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, ids], names=["doc_id", "text", "ids"]
                )

    return id_and_text(documents).mapInArrow(run, "doc_id long, text string, ids binary")


def decoded(rows: DataFrame, model_file: str | None = None) -> DataFrame:
    """The rows, which have ids, with the text that these stand for and how many are bytes.

    Bytes that are no UTF-8 become replacement characters.
    """
    names = [*rows.columns, "decoded", "n_byte_pieces"]
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", decoded string, n_byte_pieces long"
    ids_at = rows.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(model_file or default_file())
        is_byte = np.zeros(len(known.lengths), bool)
        is_byte[known.bytes] = True
        for batch in batches:
            texts, counts = [], []
            for value in batch.column(ids_at):
                ids = np.frombuffer(value.as_buffer(), "<u4") if value.is_valid else np.zeros(0, "<u4")
                size = known.lengths[ids]
                at = np.repeat(known.begins[ids] - np.cumsum(size) + size, size)
                raw = known.decoded[at + np.arange(len(at))].tobytes()
                texts.append(raw.decode("utf-8", "replace").removeprefix(" "))
                counts.append(int(is_byte[ids].sum()))
            columns = [*batch.columns, pa.array(texts, pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def round_trips(documents: DataFrame, model_file: str | None = None) -> DataFrame:
    """Pieces of every text, a checksum of their ids, and whether they decode to the text."""
    rows = decoded(encoded(documents, model_file), model_file)
    shown = F.regexp_replace("text", MARKER, " ")
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.expr("octet_length(ids) div 4").cast("long").alias("n_pieces"),
        "n_byte_pieces",
        F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == shown).alias("round_trip"),
    )
