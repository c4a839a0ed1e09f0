"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talktally.llm import quality, toxicity
from talktally.llm.collocations import collocations
from talktally.llm.decontamination import contaminated
from talktally.llm.embedding_dedup import linked_embeddings
from talktally.llm.fingerprints import document_fingerprints
from talktally.llm.frames import read_table, ship_modules
from talktally.llm.hard_negatives import hard_negatives
from talktally.llm.jaccard_join import near_duplicates
from talktally.llm.licences import licence_scan
from talktally.llm.packing import packed, pieces
from talktally.llm.pieces import round_trips
from talktally.llm.token_counts import token_counts
from talktally.llm.warc import archived

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    """The query, with this package on the executors as well."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_modules(spark)
        return query(spark, sf_dir)

    return run


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(read_table(spark, sf_dir, "documents"))


def op2_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = archived(read_table(spark, sf_dir, "pages"))
    return captures.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "position"
    )


def op3_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(read_table(spark, sf_dir, "documents"))


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(read_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality.classified(*tables)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity.classified(*tables)


def op7_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_embeddings(read_table(spark, sf_dir, "embeddings"))


def packed_documents(documents: DataFrame) -> DataFrame:
    """Where each piece of each document goes, with a checksum in place of its ids."""
    cut = pieces(documents).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed(cut)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


def op12_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(*(read_table(spark, sf_dir, name) for name in ("documents", "benchmark")))


def all_queries() -> dict[str, Query]:
    return {
        query.__name__: _shipped(query)
        for query in (
            op1_document_fingerprints,
            op2_warc_index_merge,
            op3_unigram_pieces,
            op4_licence_scan,
            op5_quality_classifier,
            op6_toxicity,
            op7_lattice_dedup,
            op8_best_fit_packing,
            op9_token_counts,
            op10_jaccard_join,
            op11_hard_negatives,
            op12_son_collocations,
            op13_winnowing,
        )
    }
