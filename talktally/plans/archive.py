"""Archives: every raw line as it came, and every message as a document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talktally.functions import document
from talktally.plans.state import window_date
from talktally.schema import ALL_EVENTS, CHANNEL_KEYS, RAW_EVENTS
from talktally.sources.parsing import non_empty


def raw_archive(raw: DataFrame) -> DataFrame:
    """Every line that is not empty, before any filter."""
    return non_empty(raw).select("value")


def all_events(messages: DataFrame) -> DataFrame:
    """Every message, in the columns of its document."""
    return messages.select(
        *CHANNEL_KEYS,
        "timestamp",
        "senderId",
        "status",
        "prevConversationType",
        F.col("previousStageName").alias("previousStage"),
        "intentName",
        "intentDetected",
        "stageName",
        F.lit(ALL_EVENTS).alias("topic"),
    )


def all_events_documents(messages: DataFrame) -> DataFrame:
    """(collection, value) of every message."""
    rows = all_events(messages)
    return rows.select(
        F.lit(ALL_EVENTS).alias("collection"), document(*rows.columns).alias("value")
    )


def event_sourcing(raw: DataFrame, messages: DataFrame) -> dict[str, DataFrame]:
    """Both archive feeds as (collection, value), by tag."""
    return {
        RAW_EVENTS: raw_archive(raw).select(F.lit(RAW_EVENTS).alias("collection"), "value"),
        ALL_EVENTS: all_events_documents(messages),
    }


def write_raw_archive(raw: DataFrame, path: str, batch_time_ms: int, batch_id: int) -> None:
    """Raw lines as text, in one directory for each batch time.

    The batch id above it makes a retried batch replace its first try.
    """
    (
        raw_archive(raw)
        .withColumn("batch_time", F.lit(batch_time_ms).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("batch_time")
        .text(f"{path}/batch_id={batch_id}")
    )


def write_archive(
    messages: DataFrame,
    path: str,
    batch_id: int = 0,
    partition_by: tuple[str, ...] = ("event_date",),
) -> None:
    """Messages as parquet by event date, each project's rows kept together.

    The rebalance hint lets Spark split the files of a large project or day and
    join small ones. Sorting by project lets a reader skip row groups of others.
    Add "projectId" to `partition_by` where there are few projects.
    """
    dated = all_events(messages).withColumn("event_date", window_date("timestamp", 0))
    (
        dated.hint("rebalance", F.col("event_date"), F.col("projectId"))
        .sortWithinPartitions("event_date", "projectId", "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(f"{path}/batch_id={batch_id}")
    )
