"""The corpus pipeline: stages that each hand documents to the next one.

Quality and toxicity drop the documents that their classifiers reject, the join keeps the
smallest id of each group of near duplicates, and packing lays the rest out in sequences.
Each stage works on all documents that the one before it kept; null texts count as empty
and pass as the classifiers decide. The join goes by texts alone: rows that share an id, or
have none, are kept or dropped as their texts are alike, and of a group rows with an id come
first. Texts without words are like no other. Empty tables pass through. The stages keep the columns of
documents; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talktally.llm import quality, toxicity
from talktally.llm.frames import SMALL_BATCH, read_table, ship_modules, stored
from talktally.llm.jaccard_join import near_duplicates
from talktally.llm.queries import packed_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of acceptable quality."""
    ship_modules(spark, SMALL_BATCH)
    tables = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = quality.fit_quality(*tables)
    return quality.accepted(docs, model)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    ship_modules(spark, SMALL_BATCH)
    tables = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = toxicity.fit_toxicity(*tables)
    return toxicity.accepted(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest id."""
    ship_modules(spark, SMALL_BATCH)
    # Rows go by numbers of their own; an id may be missing, or that of several texts.
    row = "row_number_" + "_" * max(map(len, docs.columns))
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(rows, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    known = rows.select(row, F.col("doc_id").cast("long").alias("id")).join(found, row)
    order = F.struct(F.col("id").isNull(), "id", row)
    first = known.groupBy("component_id").agg(F.min(order)[row].alias(row))
    return rows.join(first, row, "left_semi").drop(row)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes, in as few sequences as found."""
    ship_modules(spark, SMALL_BATCH)
    return packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written and read again for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
