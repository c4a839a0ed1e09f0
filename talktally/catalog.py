"""The registered queries: every operator over the driver's `events` table."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talktally import functions as fn
from talktally import operators as op
from talktally import plans, sinks, streaming
from talktally.plans.state import MetricState, merge_state
from talktally.schema import COLUMN_OF_JSON_PATH, DEFAULT_WINDOW_MS
from talktally.session import SESSION_OPTIONS, scratch_folder
from talktally.sources import (
    events_as_messages,
    events_as_raw,
    parse_events,
    quarantined,
    to_messages,
    usable,
)

DAY_MS = 86_400_000
HALF_HOUR_MS = 1_800_000
FINAL_DELAY_MS = 600_000

Query = Callable[[SparkSession, str], DataFrame]

METRICS: dict[str, Callable[..., DataFrame]] = {
    "message_count": op.message_count,
    "distinct_users": op.distinct_users,
    "time_spent": op.time_spent,
    "session_count": op.session_count,
    "resp_type": op.resp_type,
    "drop_off_intent": op.drop_off_intent,
    "drop_off_stage": op.drop_off_stage,
    "journey_nodes": op.journey_nodes,
    "intent_triggers": op.intent_triggers,
    "intent_triggers_intended": partial(op.intent_triggers, ghost_col="intentDetected"),
    "open_sessions_last": op.open_sessions_last,
    "open_sessions_first": op.open_sessions_first,
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_messages(events(spark, sf_dir))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_raw(events(spark, sf_dir))


def stream_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because a stream takes a single file only by one; it finds a folder too.
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def _metric(metric: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: metric(messages(spark, sf_dir), **options)


# Stored state


def four_batch_state(spark: SparkSession, sf_dir: str) -> MetricState:
    """Daily state kept apart in four batches that split each user's day, then merged."""
    batched = messages(spark, sf_dir).withColumn("batch", F.pmod("seq", F.lit(4)))
    state = plans.build_state(
        batched, window_ms=DAY_MS, gap_ms=HALF_HOUR_MS, split_by=("batch",)
    )
    return merge_state(state)


def _merged(metric: str) -> Query:
    return lambda spark, sf_dir: plans.metrics_of(four_batch_state(spark, sf_dir))[metric]


def user_windows_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each user's day, with the event structs flattened."""
    users = op.user_windows(messages(spark, sf_dir), DAY_MS)
    return users.select(
        "projectId",
        "channel",
        "timeMark",
        "senderId",
        "messages",
        "min_ts",
        "max_ts",
        F.col("first_event.seq").alias("first_seq"),
        F.col("last_event.seq").alias("last_seq"),
        F.col("last_intent.seq").alias("intent_seq"),
        F.col("last_intent.intentName").alias("intent"),
        F.col("last_stage.seq").alias("stage_seq"),
        F.col("last_stage.stageName").alias("stage"),
    )


def _stored_metrics(
    spark: SparkSession, sf_dir: str, window_ms: int, gap_ms: int, **groups
) -> dict[str, DataFrame]:
    """Metrics from state that is written to the shared folder once."""
    store = scratch_folder(spark, "state")
    state = plans.build_state(messages(spark, sf_dir), window_ms=window_ms, gap_ms=gap_ms, **groups)
    plans.write_state(state, store)
    whole = plans.read_state(spark, store, window_ms, gap_ms, batch_id=0, like=state, **groups)
    return plans.metrics_of(whole, **groups)


def stored_state_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write daily state as a table in the shared folder, read it, report all metrics."""
    tables = _stored_metrics(spark, sf_dir, DAY_MS, HALF_HOUR_MS)
    return plans.metric_documents(tables, DAY_MS)


def user_sketches_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily users by exact count, and whether those of stored 5-minute sketches are near.

    The sketches come in four batches that split each window, and one of them twice.
    """
    home = scratch_folder(spark, "sketches")
    rows = messages(spark, sf_dir)
    for batch_id in (0, 1, 2, 3, 3):
        part = op.user_sketches(rows.where(F.pmod("seq", F.lit(4)) == batch_id))
        plans.write_user_sketches(part, home, DEFAULT_WINDOW_MS, batch_id)
    sketches = plans.read_user_sketches(spark, home, DEFAULT_WINDOW_MS)
    about = op.users_over(sketches, DEFAULT_WINDOW_MS, DAY_MS).withColumnRenamed("users", "about")
    exact = op.user_counts(rows, DAY_MS)
    near = F.abs(F.col("about") - F.col("users")) * 100 <= F.col("users") * 3
    keys = ["projectId", "channel", "timeMark"]
    same = [exact[k].eqNullSafe(about[k]) for k in keys]
    joined = exact.join(about, same, "full_outer")
    return joined.select(*[exact[k] for k in keys], "users", near.alias("near"))


def compacted_state_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics of four batches, compacted twice; every fifth message is a batch late."""
    home = scratch_folder(spark, "compacted")
    late = F.col("seq") % 5 == 0
    day = F.call_function("div", F.col("timestamp"), F.lit(6 * DAY_MS)).cast("int")
    batched = messages(spark, sf_dir).withColumn("batch", F.pmod(day, F.lit(3)) + late.cast("int"))
    settings = {"window_ms": DAY_MS, "gap_ms": HALF_HOUR_MS}
    like = plans.build_state(batched, **settings)
    store = plans.CompactedStore(f"{home}/live", f"{home}/compacted", like)
    for batch_id in range(4):
        part = batched.where(F.col("batch") == batch_id)
        plans.write_state(plans.build_state(part, **settings), store.live, batch_id)
        if batch_id in (1, 2):
            store.compact(spark)
    # Written once more, so that the metrics share one merge.
    plans.write_state(store.read(spark), f"{home}/whole")
    whole = plans.read_state(spark, f"{home}/whole", DAY_MS, HALF_HOUR_MS, batch_id=0, like=like)
    return plans.metric_documents(plans.metrics_of(whole), DAY_MS)


# Ingest and archives


def ingest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = to_messages(raw(spark, sf_dir))
    return parsed.drop("eventTime").withColumn("seq", F.col("seq.seq"))


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined(parse_events(raw(spark, sf_dir)))


def ingest_any_key_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key in another case, in capitals on every second line."""
    value, capitals = F.col("value"), F.col("seq") % 2 == 0
    for key in sorted({k for path in COLUMN_OF_JSON_PATH for k in path.split(".")}):
        other = F.when(capitals, f'"{key.upper()}":').otherwise(f'"{key.swapcase()}":')
        value = F.replace(value, F.lit(f'"{key}":'), other)
    parsed = usable(parse_events(raw(spark, sf_dir).withColumn("value", value), any_key_case=True))
    return parsed.drop("eventTime").withColumn("seq", F.col("seq.seq"))


def resp_type_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From JSON text to the response-type metric, the live path of the original."""
    return op.resp_type(to_messages(raw(spark, sf_dir)))


def batch_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of the five-minute batches the messages would have arrived in."""
    return streaming.batch_lag(
        messages(spark, sf_dir), fn.time_mark("timestamp"), DEFAULT_WINDOW_MS
    )


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each scalar function on each message."""
    text = F.col("timestamp").cast("string")
    return messages(spark, sf_dir).select(
        "seq",
        fn.present("intentName").alias("intent_present"),
        fn.missing_to_empty("stageName").alias("stage_or_empty"),
        fn.to_long(F.concat(F.when(F.col("seq") % 2 == 0, "x").otherwise(""), text)).alias(
            "parsed"
        ),
        fn.time_mark("timestamp").alias("mark"),
        fn.zoned_text("timestamp").alias("zoned"),
        fn.response_type("status").alias("response_type"),
        fn.node_state("status").alias("node_state"),
        fn.trigger_intent().alias("trigger_intent"),
        fn.trigger_intent("intentDetected").alias("trigger_intended"),
        fn.strip_backslashes(F.concat_ws("\\", "status", "senderId")).alias("stripped"),
    )


# Sinks


def raw_archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw archive as text files, a retried batch among them, read back."""
    home = scratch_folder(spark, "raw")
    lines = raw(spark, sf_dir)
    for batch_id in (0, 1, 1):
        part = lines.where(F.pmod("seq", F.lit(2)) == batch_id)
        plans.write_raw_archive(part, home, 1000 + batch_id, batch_id)
    return spark.read.text(f"{home}/batch_id=*/batch_time=*").select("value")


def fan_out_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message's document sent to two stores, read back with the store's name."""
    home = scratch_folder(spark, "fan-out")
    documents = plans.all_events_documents(messages(spark, sf_dir))
    targets = ("parquet", "json")
    sinks.fan_out(
        documents,
        [
            lambda rows, source=source: sinks.write_store(
                rows, "events", source, path=f"{home}/{source}"
            )
            for source in targets
        ],
    )
    found = [
        spark.read.schema(documents.schema)
        .format(source)
        .load(f"{home}/{source}/events")
        .withColumn("store", F.lit(source))
        for source in targets
    ]
    return found[0].unionByName(found[1])


def _performance_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = DEFAULT_WINDOW_MS
    tables = _stored_metrics(spark, sf_dir, window, window, groups=("performance",))
    return plans.metric_documents(tables, window)


def metric_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eleven metrics as JSON documents with their collections."""
    tables = _stored_metrics(spark, sf_dir, DEFAULT_WINDOW_MS, DEFAULT_WINDOW_MS)
    return plans.metric_documents(tables, DEFAULT_WINDOW_MS)


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.kafka_records(_performance_documents(spark, sf_dir))


def keyed_kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in twelve known tasks, by their number, sent to a topic of four partitions."""
    numbered = messages(spark, sf_dir).withColumn("task", F.pmod("seq", F.lit(12)).cast("int"))
    dealt = numbered.repartitionById(12, "task")
    documents = plans.all_events_documents(dealt)
    return sinks.keyed_kafka_records(documents, topic_partitions=4, strip=True)


def dry_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stored_metrics(spark, sf_dir, DEFAULT_WINDOW_MS, DEFAULT_WINDOW_MS)
    return plans.dry_run_counts(tables, DEFAULT_WINDOW_MS)


# Streaming


def _stream_session(spark: SparkSession) -> SparkSession:
    # Its own settings, so that the caller's session keeps what it has.
    session = spark.newSession()
    for name, value in SESSION_OPTIONS.items():
        session.conf.set(name, value)
    session.conf.set(
        "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    )
    return session


def stream_partial_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All daily metrics from the merged state of a stream of raw lines."""
    session = _stream_session(spark)
    home = scratch_folder(spark, "partial")
    job = streaming.BatchJob(f"{home}/store", window_ms=DAY_MS, gap_ms=HALF_HOUR_MS)
    lines = events_as_raw(stream_of_events(session, sf_dir))
    streaming.start_partial(lines, job, f"{home}/checkpoint", every=None).awaitTermination()
    state = plans.compact_state(
        spark, f"{home}/store/state", f"{home}/whole", DAY_MS, HALF_HOUR_MS
    )
    return plans.metric_documents(plans.metrics_of(state), DAY_MS)


def stream_restarted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of a stream that stops, gets more lines and an empty file, and goes on."""
    session = _stream_session(spark)
    home = scratch_folder(spark, "restart")
    lines = raw(session, sf_dir)
    job = streaming.BatchJob(f"{home}/store", groups=("performance",), window_ms=DAY_MS)
    for part in range(3):
        # The last part has no line at all.
        lines.where(F.pmod("seq", F.lit(2)) == part).write.mode("append").parquet(f"{home}/in")
        stream = session.readStream.schema(lines.schema).parquet(f"{home}/in")
        streaming.start_partial(stream, job, f"{home}/checkpoint", every=None).awaitTermination()
    state = plans.read_state(spark, f"{home}/store/state", DAY_MS, groups=("performance",))
    return plans.metric_documents(plans.metrics_of(state, ("performance",)), DAY_MS)


def _final(metric: Callable[..., DataFrame], window_ms: int, **options) -> Query:
    """The metric of a stream that holds the table first, and later one closing message.

    That message's time is past the last window, so that all windows come out but its
    own; it passes no metric's filter.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session = _stream_session(spark)
        home = scratch_folder(spark, "final")
        rows = messages(session, sf_dir)
        closing = f"{home}/closing"
        rows.limit(0).write.parquet(closing)
        later = session.readStream.schema(rows.schema).parquet(closing)
        table = streaming.final_metric(
            events_as_messages(stream_of_events(session, sf_dir)).unionByName(later),
            metric,
            f"{FINAL_DELAY_MS} milliseconds",
            window_ms=window_ms,
            **options,
        )

        def take_all() -> None:
            streaming.start_final(
                table, f"{home}/out", f"{home}/checkpoint", every=None
            ).awaitTermination()

        take_all()
        past = F.max("timestamp") + 2 * window_ms + FINAL_DELAY_MS
        last = rows.agg(past.alias("timestamp")).withColumn("eventTime", fn.event_time("timestamp"))
        empty = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema if f.name not in last.columns}
        last.withColumns(empty).select(rows.columns).write.mode("append").parquet(closing)
        take_all()
        return spark.read.schema(table.schema).parquet(f"{home}/out")

    return run


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, metric in METRICS.items():
        found[name] = _metric(metric)
        found[f"{name}_daily"] = _metric(metric, window_ms=DAY_MS)
        found[f"stream_final_{name}"] = _final(metric, window_ms=DAY_MS)
        if name != "intent_triggers_intended":
            found[f"merged_{name}"] = _merged(name)
    found |= {
        "session_count_gap30m": _metric(
            op.session_count, window_ms=DAY_MS, gap_ms=HALF_HOUR_MS
        ),
        "session_count_gap1s": _metric(op.session_count, window_ms=DAY_MS, gap_ms=1000),
        "stream_final_session_count_gap30m": _final(
            op.session_count, window_ms=DAY_MS, gap_ms=HALF_HOUR_MS
        ),
        "time_spent_span1h": _metric(
            op.time_spent, window_ms=DAY_MS, max_span_ms=3_600_000
        ),
        "open_sessions_last_age1h": _metric(
            op.open_sessions_last, window_ms=DAY_MS, max_age_ms=3_600_000
        ),
        "user_counts": _metric(op.user_counts),
        "user_counts_daily": _metric(op.user_counts, window_ms=DAY_MS),
        "stream_final_user_counts": _final(op.user_counts, window_ms=DAY_MS),
        "user_rollup": _metric(op.user_rollup),
        "user_rollup_daily": _metric(op.user_rollup, window_ms=DAY_MS),
        "user_sketches_daily": user_sketches_daily,
        "user_windows": user_windows_flat,
        "message_counts": _metric(op.message_counts, window_ms=DAY_MS),
        "session_slices": _metric(
            op.session_slices, window_ms=DAY_MS, gap_ms=HALF_HOUR_MS
        ),
        "stored_state_metrics": stored_state_metrics,
        "compacted_state_metrics": compacted_state_metrics,
        "ingest_filter": ingest_filter,
        "ingest_quarantine": ingest_quarantine,
        "ingest_any_key_case": ingest_any_key_case,
        "resp_type_from_raw": resp_type_from_raw,
        "all_events": lambda spark, sf_dir: plans.all_events(messages(spark, sf_dir)),
        "all_events_documents": lambda spark, sf_dir: plans.all_events_documents(
            messages(spark, sf_dir)
        ),
        "raw_archive_files": raw_archive_files,
        "fan_out_documents": fan_out_documents,
        "stream_restarted_documents": stream_restarted_documents,
        "raw_archive": lambda spark, sf_dir: plans.raw_archive(raw(spark, sf_dir)),
        "batch_lag": batch_lag,
        "scalar_functions": scalar_functions,
        "metric_documents": metric_documents,
        "kafka_records": kafka_records,
        "keyed_kafka_records": keyed_kafka_records,
        "dry_run_counts": dry_run_counts,
        "stream_partial_documents": stream_partial_documents,
    }
    return found
