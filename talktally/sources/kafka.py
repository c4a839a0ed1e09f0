"""Kafka topics as raw lines. The connector package is the caller's to supply."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topics: str | list[str],
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Subscribe to topics. Offsets live in the query's checkpoint, none are committed."""
    reader = spark.readStream.format("kafka").options(
        **_options(servers, topics, starting_offsets, options)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return raw_lines(reader.load())


def read_kafka(
    spark: SparkSession,
    servers: str,
    topics: str | list[str],
    starting_offsets: str = "earliest",
    **options: str,
) -> DataFrame:
    """The same topics as a bounded table, for backfills."""
    reader = spark.read.format("kafka").options(
        **_options(servers, topics, starting_offsets, options)
    )
    return raw_lines(reader.load())


def raw_lines(records: DataFrame) -> DataFrame:
    """Kafka records to (value, seq). The order within a tie is topic, partition, offset."""
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.struct("topic", "partition", "offset").alias("seq"),
    )


def _options(servers, topics, starting_offsets, extra) -> dict[str, str]:
    names = topics if isinstance(topics, str) else ",".join(topics)
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": names,
        "startingOffsets": starting_offsets,
        **extra,
    }
