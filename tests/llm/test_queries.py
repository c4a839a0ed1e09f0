"""The registered queries over the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from talktally.llm import queries, sql
from talktally.llm.frames import read_table
from tests.conftest import SF_DIR
from tests.llm.helpers import CLASHING, documents, odd_rows
from tests.oracle_check import difference, duck_connection

CONTRACT = {
    "op1": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op2": "page_id payload_bytes payload_digest record_type refers_to",
    "op3": "doc_id n_pieces ids_crc32 round_trip",
    "op4": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op5": "doc_id held_out score predicted",
    "op6": "doc_id held_out score predicted",
    "op7": "vec_id n_links component_id kept",
    "op8": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9": "doc_id n_bytes n_tokens over_limit",
    "op10": "doc_id n_shingles component_id",
    "op11": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op12": "lang rank phrase a l r n score",
    "op13": "doc_id n_words n_hit n_items items_sha256 contaminated",
}
NAMES = queries.all_queries()


@pytest.mark.parametrize("name", NAMES)
def test_query_has_its_columns_and_all_rows(spark, name):
    found = NAMES[name](spark, SF_DIR)
    op = name.split("_")[0]
    assert set(CONTRACT[op].split()) <= set(found.columns)
    if op in ("op11", "op12"):  # these do not return a row for each row
        assert found.count() > 0
        return
    key = found.columns[0] if op != "op2" else "page_id"
    table = {"op2": "pages", "op7": "embeddings"}.get(op, "documents")
    assert found.select(key).distinct().count() == read_table(spark, SF_DIR, table).count()


@pytest.mark.parametrize("name", sql.all_sql())
def test_query_equals_sql(spark, name):
    assert difference(NAMES[name](spark, SF_DIR), duck_connection(SF_DIR), sql.all_sql()[name]) is None


def test_stages_take_odd_and_no_rows(spark):
    for rows in (odd_rows(), []):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SF_DIR)
            assert kept.columns == docs.columns == ["doc_id", "text", *CLASHING]
            assert kept.count() <= docs.count()
            docs = kept
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
        assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = stage(spark, documents(spark, odd_rows()), SF_DIR).select("doc_id").collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(i) for i in (0, 1, 2, 3, 4, 6, 7, None))


def test_near_duplicate_stage_goes_by_texts(spark):
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    one, two, three = (" ".join(f"{c}{i}" for i in range(20)) for c in "abc")
    rows = [(9, one), (5, one.upper()), (5, two), (None, two), (None, three), (None, three), (5, None), (5, "")]
    kept = stage(spark, documents(spark, rows), SF_DIR)
    assert kept.columns == ["doc_id", "text", *CLASHING]
    want = [(5, one.upper()), (5, two), (None, three), (5, None), (5, "")]
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(map(str, want))
