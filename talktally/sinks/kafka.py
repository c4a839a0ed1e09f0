"""Documents (collection, value) as Kafka records. The topic is the collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talktally.functions import strip_backslashes


def _value(strip: bool) -> Column:
    # Stripping breaks escaped JSON, so it is off unless a consumer relies on it.
    return strip_backslashes("value") if strip else F.col("value")


def kafka_records(documents: DataFrame, strip: bool = False) -> DataFrame:
    """Records without a key; Kafka spreads them over the topic's partitions."""
    return documents.select(F.col("collection").alias("topic"), _value(strip).alias("value"))


def keyed_kafka_records(
    documents: DataFrame, topic_partitions: int, strip: bool = False
) -> DataFrame:
    """Records keyed by topic, each Spark partition to one partition of the topic."""
    if topic_partitions <= 0:
        raise ValueError("topic_partitions must be positive")
    return documents.select(
        F.col("collection").alias("topic"),
        F.col("collection").alias("key"),
        _value(strip).alias("value"),
        F.pmod(F.spark_partition_id(), F.lit(topic_partitions)).cast("int").alias("partition"),
    )


def write_kafka(
    records: DataFrame, servers: str, source: str = "kafka", **options: str
) -> None:
    """Send records and wait; a failed send fails the batch, which is then retried.

    `source` is the data source name of the connector.
    """
    (
        records.write.format(source)
        .mode("append")
        .option("kafka.bootstrap.servers", servers)
        .options(**options)
        .save()
    )
