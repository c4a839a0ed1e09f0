"""Streams equal batches: partial state in any file order, final rows once closed."""

from __future__ import annotations

import glob
import json
import logging
import os
import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from talktally import operators as op
from talktally.plans import metric_groups, metrics_of, read_state
from talktally.session import scratch_folder
from talktally.__main__ import arguments, job_of, main
from talktally.sinks import log_counts, write_batch_text
from talktally.sources import read_lines, stream_lines, to_messages, usable, parse_events
from talktally.streaming import (
    BatchJob,
    LagListener,
    final_metric,
    start_final,
    start_partial,
)
from tests.helpers import T0, W, assert_same_metrics, line, rows

GAP = 60_000
STATUSES = ["nextStart", "inFlowNextValidated", "inFlowNextGhost", "cancel", None]


def make_lines(count=160, seed=1):
    draw = random.Random(seed)
    made = []
    for _ in range(count):
        status = {
            "final": draw.choice(STATUSES),
            "prevConversation": "flow",
            "previousStage": "s0",
        }
        made.append(
            line(
                draw.randrange(2 * W),
                senderId=draw.choice(["a", "b", "c", None]),
                payload={"status": status},
                conversationId=draw.choice(["i1", "i2", "", None]),
                stageName=draw.choice(["s1", "s2", None]),
            )
        )
    return [*made, "broken {", "", line(timestamp="never")]


def write_files(folder, lines, files):
    os.makedirs(folder, exist_ok=True)
    for i in range(files):
        with open(f"{folder}/{time.time_ns()}-{i}.txt", "w") as out:
            out.write("\n".join(lines[i::files]) + "\n")


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_merged_partials_equal_one_batch(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    lines = make_lines()
    random.Random(2).shuffle(lines)
    write_files(folder, lines, 4)
    job = BatchJob(store, gap_ms=GAP, keep_raw=True, keep_archive=True)
    raw = stream_lines(spark, folder, max_files_per_trigger=1)
    run(start_partial(raw, job, str(tmp_path / "cp"), every=None))

    whole = to_messages(read_lines(spark, folder))
    state = read_state(spark, f"{store}/state", gap_ms=GAP)
    expected = metric_groups(whole, gap_ms=GAP)
    assert_same_metrics(metrics_of(state), expected)

    assert spark.read.parquet(f"{store}/archive").count() == whole.count()
    assert spark.read.text(f"{store}/raw").count() == len(lines) - 1
    reasons = spark.read.parquet(f"{store}/quarantine")
    assert rows(reasons.select("reason")) == [("bad_timestamp",), ("malformed",)]
    lag = spark.read.parquet(f"{store}/lag")
    assert lag.select("batch_id").distinct().count() == 4
    assert lag.agg(F.sum("messages")).first()[0] == whole.count()


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    folder, store, cp = (str(tmp_path / n) for n in ("in", "store", "cp"))
    lines = make_lines()
    job = BatchJob(store, gap_ms=GAP)
    write_files(folder, lines[:60], 2)
    run(start_partial(stream_lines(spark, folder, 1), job, cp, every=None))
    write_files(folder, lines[60:], 2)
    for _ in range(2):
        run(start_partial(stream_lines(spark, folder, 1), job, cp, every=None))
    state = read_state(spark, f"{store}/state", gap_ms=GAP)
    expected = metric_groups(to_messages(read_lines(spark, folder)), gap_ms=GAP)
    assert_same_metrics(metrics_of(state), expected)


def test_a_batch_that_failed_half_way_is_replaced(spark, tmp_path):
    folder, store, cp = (str(tmp_path / n) for n in ("in", "store", "cp"))
    write_files(folder, make_lines(), 2)
    calls = []

    def broken_once(documents, batch_id):
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("sink down")
        write_batch_text(documents, f"{store}/documents", batch_id)

    job = BatchJob(store, gap_ms=GAP, document_sinks=(broken_once,))
    first = start_partial(stream_lines(spark, folder, 1), job, cp, every=None)
    with pytest.raises(Exception, match="sink down"):
        first.awaitTermination()
    run(start_partial(stream_lines(spark, folder, 1), job, cp, every=None))
    assert calls == [0, 1, 1]

    state = read_state(spark, f"{store}/state", gap_ms=GAP)
    expected = metric_groups(to_messages(read_lines(spark, folder)), gap_ms=GAP)
    assert_same_metrics(metrics_of(state), expected)
    documents = spark.read.text(f"{store}/documents")
    counts = documents.filter("collection = 'respType_300'").collect()
    assert sum(json.loads(r["value"])["count"] for r in counts) == 160


def test_archive_sinks_get_raw_lines_and_messages(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_files(folder, ["broken", line(), line(requestAssistance=True)], 1)
    sent = {}

    def keep(documents, batch_id):
        for row in documents.collect():
            sent.setdefault(row["collection"], []).append(row["value"])

    job = BatchJob(str(tmp_path / "s"), groups=(), archive_sinks=(keep, log_counts))
    run(start_partial(stream_lines(spark, folder), job, str(tmp_path / "cp"), every=None))
    assert len(sent["eventSourcedData"]) == 3 and "broken" in sent["eventSourcedData"]
    assert [json.loads(v)["intentName"] for v in sent["allEvents"]] == ["i1"]


def test_the_whole_job_from_the_command_line(spark, tmp_path):
    folder, store, cp = (str(tmp_path / n) for n in ("in", "store", "cp"))
    write_files(folder, make_lines(30), 1)
    given = ["--lines", folder, "--store", store, "--checkpoint", cp, "--once", "--dry-run"]
    main([*given, "--groups", "performance", "--keep-archive"])
    state = read_state(spark, f"{store}/state", groups=["performance"])
    whole = to_messages(read_lines(spark, folder))
    expected = metric_groups(whole, ["performance"])
    assert_same_metrics(metrics_of(state, ["performance"]), expected)
    with pytest.raises(SystemExit):
        main(["--topics", "t", "--store", store, "--checkpoint", cp])


def test_store_and_topic_get_the_same_rows_with_the_batch(spark, tmp_path):
    folder, store, kept = (str(tmp_path / n) for n in ("in", "store", "kept"))
    write_files(folder, make_lines(60), 1)
    sent: dict[int, list[str]] = {}

    def topic(documents, batch_id):
        found = [json.loads(r["value"]) for r in documents.collect()]
        sent.setdefault(batch_id, []).append(sorted(json.dumps(d, sort_keys=True) for d in found))

    options = arguments(
        ["--lines", folder, "--store", store, "--checkpoint", str(tmp_path / "cp"), "--gap-seconds", "60"]
        + ["--documents-format", "json", "--documents-option", f"path={kept}", "--any-key-case"]
    )
    job = replace(job_of(options), document_sinks=(topic,), clock=lambda: 1000.0)
    raw = read_lines(spark, folder)
    job(raw, 7)
    job(raw, 7)
    # A retry sends the same rows under the same batch, by which they are told apart.
    assert sent[7][0] == sent[7][1] and all('"batchId": 7' in d for d in sent[7][0])
    stored = [
        json.dumps(json.loads(line), sort_keys=True)
        for file in glob.glob(f"{kept}/*/part-*")
        for line in open(file, encoding="utf-8")
    ]
    drop_nulls = [
        json.dumps({k: v for k, v in json.loads(d).items() if v is not None}, sort_keys=True)
        for d in sent[7][0] + sent[7][1]
    ]
    assert sorted(stored) == sorted(drop_nulls)


def test_options_reach_the_job(tmp_path):
    given = ["--lines", "in", "--store", "s", "--checkpoint", "c", "--servers", "b:1"]
    job = job_of(arguments([*given, "--publish-events", "--ghost-col", "intentDetected", "--any-key-case"]))
    assert job.ghost_col == "intentDetected" and job.parse_options == {"any_key_case": True}
    assert len(job.archive_sinks) == 1 and not job.table_sinks
    with pytest.raises(SystemExit):
        arguments(given[:-2] + ["--publish-events"])


def test_final_mode_from_the_command_line(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    for lines in ([line(0), line(1, senderId="u2")], [line(100 * W)], [line(101 * W)]):
        write_files(folder, lines, 1)
        time.sleep(0.05)
    main(
        ["--lines", folder, "--store", store, "--checkpoint", str(tmp_path / "cp"), "--once"]
        + ["--final", "distinct_users", "--final-delay-seconds", "1", "--max-per-batch", "1"]
    )
    found = spark.read.parquet(f"{store}/distinct_users").filter(F.col("timeMark") == T0 + W)
    assert sorted(r["senderId"] for r in found.collect()) == ["u1", "u2"]


def test_a_batch_without_messages_is_no_trouble(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    write_files(folder, ["broken", line(projectId="")], 1)
    sent = []
    job = BatchJob(
        store, gap_ms=GAP, document_sinks=(lambda docs, batch: sent.append(docs.count()),)
    )
    run(start_partial(stream_lines(spark, folder), job, str(tmp_path / "cp"), every=None))
    assert sent == [0]


def _final(spark, tmp_path, metric, name, **options):
    stream = usable(parse_events(stream_lines(spark, str(tmp_path / "in"), 1)))
    table = final_metric(stream, metric, "1 second", **options)
    out = str(tmp_path / f"out-{name}")
    run(start_final(table, out, str(tmp_path / f"cp-{name}"), every=None))
    return spark.read.schema(table.schema).parquet(out)


@pytest.mark.parametrize(
    ("metric", "options"),
    [
        (op.resp_type, {}),
        (op.time_spent, {}),
        (op.drop_off_intent, {}),
        (op.open_sessions_last, {}),
        (op.session_count, {"gap_ms": GAP}),
        (op.session_count, {"gap_ms": 1}),
    ],
)
def test_final_rows_equal_the_batch_once_closed(spark, tmp_path, monkeypatch, metric, options):
    monkeypatch.setattr("talktally.operators.sessions.FAN_IN", 600)
    folder = str(tmp_path / "in")
    write_files(folder, make_lines(), 1)
    time.sleep(0.05)
    # A message far ahead closes every window before it; its own window stays open.
    write_files(folder, [line(100 * W)], 1)
    got = _final(spark, tmp_path, metric, "m", **options)
    whole = to_messages(read_lines(spark, folder)).filter(F.col("timestamp") < T0 + 90 * W)
    assert rows(got) == rows(metric(whole, **options))


@pytest.mark.parametrize(
    "metric", [op.drop_off_intent, op.drop_off_stage, op.journey_nodes, op.intent_triggers]
)
def test_messages_that_a_metric_leaves_out_close_its_windows(spark, tmp_path, metric):
    folder = str(tmp_path / "in")
    journey = {"final": "inFlowNextValidated", "prevConversation": "flow", "previousStage": "s0"}
    counted = [line(0), line(1, payload={"status": journey})]
    other = {"payload": {"status": {"final": "cancel"}}, "conversationId": None}
    for lines in (counted, [line(100 * W, **other)], [line(101 * W, **other)]):
        write_files(folder, lines, 1)
        time.sleep(0.05)
    got = _final(spark, tmp_path, metric, "m")
    whole = to_messages(read_lines(spark, folder))
    assert got.count() > 0
    assert rows(got) == rows(metric(whole.filter(F.col("timestamp") < T0 + W)))


def test_late_rows_are_left_out_of_final_but_not_of_partial(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    # Each file is a batch. The last message of all is for a window closed before.
    for at in (0, 100 * W, 101 * W, 1):
        write_files(folder, [line(at)], 1)
        time.sleep(0.05)
    final = _final(spark, tmp_path, op.message_count, "m")
    assert [r["count"] for r in final.filter(F.col("timeMark") == T0 + W).collect()] == [1]
    raw = stream_lines(spark, folder, max_files_per_trigger=1)
    run(start_partial(raw, BatchJob(store), str(tmp_path / "cp"), every=None))
    counts = metrics_of(read_state(spark, f"{store}/state"))["message_count"]
    assert [r["count"] for r in counts.filter(F.col("timeMark") == T0 + W).collect()] == [2]


def test_final_mode_needs_a_stream(spark, tmp_path):
    write_files(str(tmp_path / "in"), make_lines(5), 1)
    with pytest.raises(ValueError, match="needs a stream"):
        final_metric(to_messages(read_lines(spark, str(tmp_path / "in"))), op.resp_type)


def test_listener_logs_each_batch(spark, tmp_path, caplog):
    folder = str(tmp_path / "in")
    write_files(folder, make_lines(20), 2)
    listener = LagListener()
    spark.streams.addListener(listener)
    try:
        with caplog.at_level(logging.INFO, logger="talktally.streaming.lag"):
            raw = stream_lines(spark, folder, max_files_per_trigger=1)
            job = BatchJob(str(tmp_path / "s"), groups=())
            run(start_partial(raw, job, str(tmp_path / "cp"), every=None))
            deadline = time.time() + 20
            while "batch 1:" not in caplog.text and time.time() < deadline:
                time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert "batch 0:" in caplog.text and "batch 1:" in caplog.text


def test_scratch_folder_is_shared_and_new_each_time(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one.startswith(shared) and one != two
