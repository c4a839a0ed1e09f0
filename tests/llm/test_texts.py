"""Fingerprints, pieces, licences and token counts against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from talktally.llm import bpe, fingerprints, licences, pieces, token_counts, units, words
from talktally.llm.frames import utf8
from tests.llm.helpers import documents, odd_rows, sentences

ODD = list("ab cZ9\x00\n\t '.,!é×ÿ½² 漢\r\x1c_-") + ["<|endoftext|>", "'re", "\U0001f600", "é ", "  "]


def texts(seed: int, count: int, most: int = 40, alphabet=ODD) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, most))) for _ in range(count)]


def library(text: str) -> list[int]:
    return bpe.tokenizer(bpe.default_file()).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("block", [1 << 20, 37])
def test_words_are_those_of_the_pattern(monkeypatch, block):
    monkeypatch.setattr(words, "BLOCK", block)
    table = words.byte_table(words.WHITE)
    rows, seen = texts(1, 800), {}
    data, ends = utf8(pa.array(rows))
    for found in words.words_of(data, ends, table):
        for i in range(found.first, found.last):
            want = re.findall(r"[^\x20\x09-\x0D]+", rows[i])
            want = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in want]
            got = found.hashes[found.row == i - found.first].tolist()
            assert len(got) == len(want)
            for word, code in zip(want, got, strict=True):
                assert seen.setdefault(word, code) == code
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("block", [1 << 22, 64])
def test_units_give_the_ids_of_the_whole(monkeypatch, block):
    monkeypatch.setattr(units, "BLOCK", block)
    rows = texts(2, 1500) + texts(3, 3, 3000)
    data, ends = utf8(pa.array([*rows, None]))
    got = {}
    for b in bpe.unit_encoder(bpe.default_file()).batches(data, ends):
        for i in range(b.first, b.last):
            got[i] = b.ids[b.ends[i - b.first] : b.ends[i - b.first + 1]].tolist()
    assert [got[i] for i in range(len(rows))] == [library(t) for t in rows]
    assert got[len(rows)] == []


@pytest.mark.parametrize(("chunk", "overlap"), [(100, 80), (64, 32), (1000, 90)])
def test_spliced_chunks_give_the_ids_of_the_whole(chunk, overlap):
    ends = token_counts._with_ends(bpe.default_file())
    rows = texts(4, 60, 900) + ["x" * 2000, "y" * 700 + " z" * 300, "é" * 50 + " <|endoftext|>" * 40]
    for text in rows:
        parts = token_counts.spliced_ids(text, ends, chunk, overlap, 16)
        assert [i for p in parts for i in p] == library(text)


def test_token_counts_of_odd_rows(spark):
    rows = odd_rows()
    found = token_counts.token_counts(documents(spark, rows), huge_chars=5000, chunk_chars=700, overlap_chars=99)
    got = Counter(map(tuple, found.collect()))
    want = Counter(
        (i, len((t or "").encode()), len(library(t or "")), len(library(t or "")) > 512) for i, t in rows
    )
    assert got == want
    assert token_counts.token_counts(documents(spark, [])).count() == 0


def test_fingerprints_are_of_the_multiset_of_paragraphs():
    rows = texts(5, 1500, 25, ["a ", "b", "\n", "cé ", " ", "d e f g"]) + ["", "\n", "a", "a\n"]
    seen: dict = {}
    for text, found in zip(rows, fingerprints.fingerprints(pa.array(rows)), strict=True):
        key = frozenset(Counter(text.split("\n") if text else []).items())
        seen.setdefault(key, set()).add(found.tobytes())
    assert all(len(s) == 1 for s in seen.values())
    assert len({x for s in seen.values() for x in s}) == len(seen)


def test_fingerprints_change_by_paragraphs():
    def of(*paragraphs):
        return fingerprints.fingerprints(pa.array(["\n".join(paragraphs)]))[0]

    before = of("x y z w", "", "q r s t u", "x y z w")
    after = fingerprints.changed(before, ["new one here"], ["x y z w", "", "x y z w"])
    assert (after == of("q r s t u", "new one here")).all()


@pytest.mark.parametrize("block_rows", [2, 8000])
def test_document_fingerprints(spark, block_rows):
    rows = [r for r in odd_rows() if r[0] != 5] + [(10 + i, t) for i, t in enumerate(sentences(1, 30))]
    got = {r["doc_id"]: r for r in fingerprints.document_fingerprints(documents(spark, rows), block_rows).collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        edited = fingerprints.edited(text, after)
        a, b, c = fingerprints.fingerprints(pa.array([text, edited, after]))[:, None]
        row = got[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == fingerprints.as_text(a[0])
        assert row["edited_fingerprint"] == fingerprints.as_text(b[0])
        assert row["near_edited"] == pytest.approx(fingerprints.likeness(a, b)[0])
        assert row["near_next"] == pytest.approx(fingerprints.likeness(a, c)[0])


def test_repeated_and_lone_rows_have_fingerprints(spark):
    same = fingerprints.document_fingerprints(documents(spark, [(1, "a b c d"), (1, "a b c d")])).collect()
    assert [r["near_next"] for r in same] == [1.0, 1.0]
    assert fingerprints.document_fingerprints(documents(spark, [(1, None)])).first()["near_edited"] == 1.0
    assert fingerprints.document_fingerprints(documents(spark, [])).count() == 0


def test_pieces_are_those_of_the_library(tmp_path):
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    with open(pieces.default_file(), "rb") as file:
        spec.ParseFromString(file.read())
    spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
    for piece in spec.pieces:  # the library adds in single precision, which huge scores spoil
        piece.score = max(piece.score, -40_000.0)
    file = str(tmp_path / "unigram.model")
    with open(file, "wb") as out:
        out.write(spec.SerializeToString())
    known = SentencePieceProcessor(model_file=file)
    rows = texts(6, 1500, 40, list("abcdefghimnoprst") * 2 + list("  é.,'0漢") + ["the", "ing", "\n"])
    data, ends = utf8(pieces.normalised(pa.array(rows)))
    for b in pieces.unit_encoder(file).batches(data, ends):
        for i in range(b.first, b.last):
            ids = b.ids[b.ends[i - b.first] : b.ends[i - b.first + 1]].tolist()
            assert ids == known.encode(rows[i])
            assert pieces.model(file).viterbi(f" {rows[i]}".replace(" ", "▁") if rows[i] else "") == ids


def test_double_array_trie_holds_its_keys_only():
    rng = random.Random(7)
    keys = sorted({bytes(rng.choices(b"abc\xff\x00", k=rng.randint(1, 6))) for _ in range(600)})
    trie = pieces.DoubleArrayTrie(keys, list(range(len(keys))))

    def get(key: bytes) -> int:
        at = 0
        for byte in key:
            child = trie.base[at] + byte
            if trie.check[child] != at or not child:
                return -1
            at = child
        return trie.value[at]

    assert [get(k) for k in keys] == list(range(len(keys)))
    others = {bytes(rng.choices(b"abcd\xff", k=rng.randint(1, 7))) for _ in range(500)} - set(keys)
    assert {get(k) for k in others} == {-1}


def test_piece_round_trips(spark):
    rows = odd_rows()
    got = pieces.round_trips(documents(spark, rows)).collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    known = pieces.model(pieces.default_file())
    ids = known.viterbi("▁a")
    (row,) = [r for r in got if r["doc_id"] == 6]
    assert (row["n_pieces"], row["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert {r["n_pieces"] for r in got if r["doc_id"] in (1, 2)} == {0}
    marked = pieces.round_trips(documents(spark, [(1, "a▁b")])).first()
    assert marked["round_trip"] and marked["decoded_sha256"] == hashlib.sha256(b"a b").hexdigest()
    assert pieces.round_trips(documents(spark, [])).count() == 0


def plain_scan(text: str) -> tuple:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = []
    for phrase, label in licences.BASE_PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(found)) if found[i : i + len(parts)] == parts]
    at = [i for i, _ in places]
    return (
        len(found), len(places), min(at, default=None), max(at, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def test_licence_scan_equals_plain_search(spark):
    alphabet = ["cc", "by", "CC-BY", "general", "public", "license", "All", "rights", "reserved", "é", "x"]
    rng = random.Random(8)
    rows = odd_rows() + [
        (100 + i, "".join(w + rng.choice([" ", "\n", ".", "é", ""]) for w in rng.choices(alphabet, k=30)))
        for i in range(300)
    ]
    got = licences.licence_scan(documents(spark, rows)).collect()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    shown = Counter((r["doc_id"], *(r[n] for n in names)) for r in got)
    assert shown == Counter((i, *plain_scan(t or "")) for i, t in rows)
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) for r in got)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert licences.licence_scan(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("expression", "terms", "strictness"),
    [
        ("MIT", ["mit"], licences.FREE),
        ("MIT OR GPL-3.0-only", ["mit", "gpl-3.0-only", "or"], licences.FREE),
        ("MIT AND GPL-3.0-only", ["mit", "gpl-3.0-only", "and"], licences.COPYLEFT),
        ("A OR MIT AND GPL", ["a", "mit", "gpl", "and", "or"], licences.COPYLEFT),
        ("(MIT OR Foo) AND ISC", ["mit", "foo", "or", "isc", "and"], licences.FREE),
        ("GPL-2.0 WITH Classpath OR Foo", ["gpl-2.0", "classpath", "with", "foo", "or"], 1),
        ("MIT */ more", ["mit"], licences.FREE),
        ("MIT OR", ["mit"], licences.FREE),
        ("(MIT", [], None),
        ("OR MIT", [], None),
        ("", [], None),
    ],
)
def test_licence_expressions(expression, terms, strictness):
    assert licences.postfix(expression) == terms
    if terms:
        assert licences.evaluated(terms) == strictness
