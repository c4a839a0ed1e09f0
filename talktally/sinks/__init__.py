"""Where documents and tables go: Kafka, a document store, files."""

from talktally.sinks.dry_run import log_counts
from talktally.sinks.fanout import fan_out
from talktally.sinks.files import write_batch_parquet, write_batch_text
from talktally.sinks.kafka import kafka_records, keyed_kafka_records, write_kafka
from talktally.sinks.store import write_store

__all__ = [
    "fan_out",
    "kafka_records",
    "keyed_kafka_records",
    "log_counts",
    "write_batch_parquet",
    "write_batch_text",
    "write_kafka",
    "write_store",
]
