"""Run the analytics as one job: `python -m talktally --help`."""

from __future__ import annotations

import argparse
import logging
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from talktally import operators as op
from talktally import sinks
from talktally.plans import GROUPS
from talktally.session import SESSION_OPTIONS
from talktally.sources import stream_kafka, stream_lines, to_messages
from talktally.streaming import (
    BatchJob,
    LagListener,
    final_metric,
    start_final,
    start_partial,
)

FINAL_METRICS = {
    metric.__name__: metric
    for metric in (
        op.message_count,
        op.distinct_users,
        op.time_spent,
        op.session_count,
        op.resp_type,
        op.drop_off_intent,
        op.drop_off_stage,
        op.journey_nodes,
        op.intent_triggers,
        op.open_sessions_last,
        op.open_sessions_first,
    )
}


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="talktally", description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--topics", nargs="+", help="Kafka topics to read")
    source.add_argument("--lines", help="folder of JSON line files to read")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--store", required=True, help="shared folder for results")
    parser.add_argument("--checkpoint", required=True, help="shared folder for offsets")
    parser.add_argument("--groups", nargs="*", choices=list(GROUPS), default=list(GROUPS))
    parser.add_argument("--window-seconds", type=int, default=300)
    parser.add_argument("--gap-seconds", type=int)
    parser.add_argument("--keep-raw", action="store_true")
    parser.add_argument("--keep-archive", action="store_true")
    parser.add_argument("--keep-reach", action="store_true", help="store sketches of users")
    parser.add_argument("--compact-every", type=int, help="batches that are merged at a time")
    parser.add_argument("--publish", action="store_true", help="send documents to Kafka")
    parser.add_argument(
        "--publish-events", action="store_true", help="send raw lines and messages to Kafka, keyed"
    )
    parser.add_argument("--topic-partitions", type=int, default=1, help="of topics with keys")
    parser.add_argument("--documents-format", help="data source to append metric rows to")
    parser.add_argument("--documents-option", nargs="*", default=[], metavar="KEY=VALUE")
    parser.add_argument("--any-key-case", action="store_true", help="match JSON keys in any case")
    parser.add_argument("--ghost-col", choices=["stageName", "intentDetected"], default="stageName")
    parser.add_argument(
        "--final", choices=sorted(FINAL_METRICS), help="append this metric once windows close"
    )
    parser.add_argument("--final-delay-seconds", type=int, default=600)
    parser.add_argument("--dry-run", action="store_true", help="log document counts")
    parser.add_argument("--max-per-batch", type=int, help="offsets or files for each batch")
    parser.add_argument("--once", action="store_true", help="take what is there and stop")
    options = parser.parse_args(given)
    if (options.topics or options.publish or options.publish_events) and not options.servers:
        parser.error("--topics, --publish and --publish-events need --servers")
    return options


def publish(documents: DataFrame, batch_id: int, servers: str) -> None:
    sinks.write_kafka(sinks.kafka_records(documents), servers)


def publish_keyed(
    documents: DataFrame, batch_id: int, servers: str, topic_partitions: int
) -> None:
    records = sinks.keyed_kafka_records(documents, topic_partitions)
    sinks.write_kafka(records, servers)


def store_table(
    collection: str, table: DataFrame, batch_id: int, source: str, given: dict[str, str]
) -> None:
    sinks.write_store(table, collection, source, **given)


def job_of(options: argparse.Namespace) -> BatchJob:
    targets, tables, archives = [], [], []
    if options.documents_format:
        given = dict(pair.split("=", 1) for pair in options.documents_option)
        tables.append(partial(store_table, source=options.documents_format, given=given))
    if options.publish_events:
        archives.append(
            partial(
                publish_keyed,
                servers=options.servers,
                topic_partitions=options.topic_partitions,
            )
        )
    if options.publish:
        targets.append(partial(publish, servers=options.servers))
    if options.dry_run:
        targets.append(sinks.log_counts)
    gap = options.gap_seconds
    return BatchJob(
        store=options.store,
        groups=tuple(options.groups),
        window_ms=options.window_seconds * 1000,
        gap_ms=None if gap is None else gap * 1000,
        keep_raw=options.keep_raw,
        keep_archive=options.keep_archive,
        keep_reach=options.keep_reach,
        compact_every=options.compact_every,
        ghost_col=options.ghost_col,
        parse_options={"any_key_case": options.any_key_case},
        document_sinks=tuple(targets),
        table_sinks=tuple(tables),
        archive_sinks=tuple(archives),
    )


def final_table(raw: DataFrame, options: argparse.Namespace) -> DataFrame:
    metric, chosen = FINAL_METRICS[options.final], {}
    if options.final == "intent_triggers":
        chosen["ghost_col"] = options.ghost_col
    if options.final == "session_count" and options.gap_seconds is not None:
        chosen["gap_ms"] = options.gap_seconds * 1000
    return final_metric(
        to_messages(raw, any_key_case=options.any_key_case),
        metric,
        f"{options.final_delay_seconds} seconds",
        window_ms=options.window_seconds * 1000,
        **chosen,
    )


def main(given: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    options = arguments(given)
    builder = SparkSession.builder.appName("talktally")
    for name, value in SESSION_OPTIONS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    listener = LagListener()
    spark.streams.addListener(listener)
    if options.topics:
        raw = stream_kafka(
            spark,
            options.servers,
            options.topics,
            max_offsets_per_trigger=options.max_per_batch,
        )
    else:
        raw = stream_lines(spark, options.lines, options.max_per_batch)
    every = None if options.once else f"{options.window_seconds} seconds"
    try:
        if options.final:
            start_final(
                final_table(raw, options), f"{options.store}/{options.final}", options.checkpoint, every
            ).awaitTermination()
        else:
            start_partial(raw, job_of(options), options.checkpoint, every).awaitTermination()
    finally:
        spark.streams.removeListener(listener)


if __name__ == "__main__":
    main()
