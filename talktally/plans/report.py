"""Metrics as JSON documents, and counts of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talktally import schema as s
from talktally.functions import collection_name, document

_TAGS = {
    "message_count": s.MESSAGE_COUNT,
    "distinct_users": s.DISTINCT_USERS,
    "time_spent": s.TIME_SPENT,
    "session_count": s.SESSION_COUNT,
    "resp_type": s.RESPONSE_TYPE,
    "drop_off_intent": s.DROP_OFF_INTENT,
    "drop_off_stage": s.DROP_OFF_STAGE,
    "journey_nodes": s.JOURNEY_NODES,
    "intent_triggers": s.INTENT_TRIGGER,
    "open_sessions_last": s.OPEN_SESSIONS,
    "open_sessions_first": s.OPEN_SESSIONS,
}


def tag_of(metric: str) -> str:
    return _TAGS[metric]


def with_window_and_topic(table: DataFrame, metric: str, window_ms: int) -> DataFrame:
    """A metric with the two columns every emitted document ends in."""
    named = (
        table.withColumnRenamed("previousStageName", "previousStage")
        if metric == "journey_nodes"
        else table
    )
    return named.withColumn("window", F.lit(window_ms).cast("bigint")).withColumn(
        "topic", F.lit(tag_of(metric))
    )


def typed_documents(
    tables: dict[str, DataFrame], window_ms: int, stamps: dict[str, Column] | None = None
) -> list[tuple[str, DataFrame]]:
    """Collection and rows of each metric, with the columns that every document ends in.

    `stamps` are further columns, such as the batch a document comes from.
    """
    return [
        (
            collection_name(tag_of(metric), window_ms),
            with_window_and_topic(table, metric, window_ms).withColumns(stamps or {}),
        )
        for metric, table in tables.items()
    ]


def metric_documents(
    tables: dict[str, DataFrame], window_ms: int, stamps: dict[str, Column] | None = None
) -> DataFrame:
    """(collection, value): one JSON document for each row of each metric."""
    frames = [
        full.select(
            F.lit(collection).alias("collection"), document(*full.columns).alias("value")
        )
        for collection, full in typed_documents(tables, window_ms, stamps)
    ]
    return reduce(DataFrame.unionAll, frames)


def dry_run_counts(tables: dict[str, DataFrame], window_ms: int) -> DataFrame:
    """How many documents each metric would send, as one query.

    First and last events share a collection but are counted apart.
    """
    frames = [
        table.agg(F.count(F.lit(1)).alias("documents")).select(
            F.lit(metric).alias("metric"),
            F.lit(collection_name(tag_of(metric), window_ms)).alias("collection"),
            "documents",
        )
        for metric, table in tables.items()
    ]
    return reduce(DataFrame.unionAll, frames)
