"""Archives that are read back, merged runs, and packed pieces."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from talktally.llm import bpe, packing, warc
from talktally.llm.grouping_ga import Effort, best_fit, crossover, evolve, exact_fit, fewest_bins, mutated
from talktally.llm.loser_tree import merged
from tests.llm.helpers import documents, odd_rows

PAGES = "page_id long, url string, html string, stamp string, run string"


def odd_pages() -> list[tuple]:
    body = "<p>same</p>\r\n\r\nWARC/1.0\r\n" * 60
    return [
        (0, "http://A.example.com/x?y#z", body, "s", "r"),
        (1, "http://a.example.com/x?y", "short", "s", "r"),
        (2, "http://b.example.com", body, "s", "r"),
        (3, None, body + "\n", "s", "r"),
        (4, "http://b.example.com\r\nX: y", None, "s", "r"),
        (5, "nonsense", "", "s", "r"),
        (6, "http://b.example.com", "short", "s", "r"),
        (7, "http://ü.example.com/é", "é漢\n\r\n" * 400, "s", "r"),
        (8, "http://b.example.com", body, "s", "r"),
        (8, "http://b.example.com", body, "s", "r"),
        (None, "http://b.example.com", body, "s", "r"),
        (10, "http://c.example.com", "x" * 999, "s", "r"),
        (11, "http://c.example.com", "x" * 999, "s", "r"),
        (12, "http://c.example.com", "y" * 1000 + "\r\n\r\n", "s", "r"),
        (13, "http://c.example.com", "y" * 1000 + "\r\n\r\n", "s", "r"),
        (14, "http://d.example.com", "z" * 3_000_000, "s", "r"),
    ]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(odd_pages(), PAGES).repartition(3)
    warc.write_archive(pages, str(tmp_path / "w"))
    got = warc.read_archive(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(odd_pages())
    largest: dict = {}
    for page, _, html, *_ in odd_pages():
        if page is not None and len((html or "").encode()) >= 1000:
            largest[html] = max(largest.get(html, -1), page)
    shown = {r["page_id"]: r for r in got}
    for page, _, html, *_ in odd_pages():
        raw, row = (html or "").encode(), shown[page]
        assert (row["payload_bytes"], row["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        refers = largest.get(html) if len(raw) >= 1000 and page != largest.get(html) else None
        assert (row["record_type"], row["refers_to"]) == ("revisit" if refers is not None else "response", refers)
        assert row["payload"] == (None if refers is not None else html or "")


@pytest.mark.parametrize("range_rows", [3, 50_000])
def test_index_is_in_order(spark, range_rows):
    pages = spark.createDataFrame(odd_pages(), PAGES).repartition(4)
    path = str(warc.scratch_folder(spark, "test-warc"))
    warc.write_archive(pages, path)
    found = warc.merged_index(warc.read_archive(spark, path).drop("payload"), range_rows)
    rows = sorted(found.collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(len(odd_pages())))
    keys = [(r["url_key"], r["stamp"], -1 if r["page_id"] is None else r["page_id"]) for r in rows]
    assert keys == sorted(keys)
    assert {r["page_id"]: r["url_key"] for r in rows}[0] == "com,example,a)/x?y"


def test_archive_of_no_pages(spark):
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("count", [0, 1, 2, 3, 7, 40])
def test_merged_runs(count):
    rng = random.Random(count)
    runs = [sorted((rng.randint(0, 9), i) for _ in range(rng.randint(0, 8))) for i in range(count)]
    assert list(merged(runs)) == sorted(x for run in runs for x in run)


def assert_packed(bins, lengths, capacity):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= capacity for b in bins)


@pytest.mark.parametrize("seed", range(5))
def test_genetic_operators_keep_packings_whole(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 100) for _ in range(rng.choice([1, 5, 200]))]
    order = list(range(len(lengths)))
    first = best_fit([], order, lengths, 100)
    second = exact_fit(order, lengths, 100, rng)
    child = crossover(first, second, lengths, 100, rng)
    for bins in (first, second, child, mutated(child, lengths, 100, rng)):
        assert_packed(bins, lengths, 100)
    best = evolve(lengths, 100, [], seed, Effort(population=5, generations=20))[0]
    assert_packed(best, lengths, 100)
    plain = best_fit([], sorted(order, key=lambda i: -lengths[i]), lengths, 100)
    assert fewest_bins(lengths, 100) <= len(best) <= len(plain)


def test_packed_pieces(spark):
    rng = random.Random(9)
    rows = odd_rows() + [(100 + i, " ".join(["word"] * rng.randint(1, 60))) for i in range(200)]
    plan = packing.PackingPlan(pool_items=60, islands=2, rounds=2, levels=2)
    cut = packing.pieces(documents(spark, rows), capacity=64)
    got = [r.asDict() for r in packing.packed(cut, 64, plan).collect()]
    by_doc: dict = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, text in dict(rows).items():
        ids = bpe.tokenizer(bpe.default_file()).encode(text or "", add_special_tokens=False).ids + [2]
        copies = sum(1 for d, _ in rows if d == i)
        found = sorted(by_doc[i], key=lambda r: r["start"])
        assert len(found) == copies * -(-len(ids) // 64)
        for r in found:
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids[r["start"] : r["start"] + r["length"]]
            assert r["length"] == 64 or r["piece"] == 0
    bins: dict = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in bins.values():
        members.sort()
        assert [o for o, _ in members] == [sum(n for _, n in members[:k]) for k in range(len(members))]
        assert sum(n for _, n in members) <= 64
    total = sum(r["length"] for r in got)
    assert len(bins) <= -(-total // 64) * 1.05 + 1
    assert packing.packed(packing.pieces(documents(spark, [])), 64).count() == 0


def test_checksum_of_ids(spark):
    from talktally.llm.queries import packed_documents

    row = packed_documents(documents(spark, [(1, None)])).first()
    assert (row["length"], row["ids_crc32"]) == (1, zlib.crc32(np.array([2], "<u4").tobytes()))
