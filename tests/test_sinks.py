"""Documents, record frames and files. No Kafka or document store runs here."""

from __future__ import annotations

import json

import pytest

from talktally import sinks
from talktally.plans import (
    all_events_documents,
    dry_run_counts,
    metric_documents,
    metric_groups,
    raw_archive,
    write_archive,
    write_raw_archive,
)
from tests.helpers import T0, W, message, messages, rows


def sample(spark):
    return messages(
        spark,
        message(0, status="inFlowNextValidated", stageName='say "hi"\\now'),
        message(1, channel=None, status="nextStart"),
    )


def test_documents_are_json_with_window_and_topic(spark):
    docs = metric_documents(metric_groups(sample(spark)), W)
    assert docs.columns == ["collection", "value"]
    found = {}
    for row in docs.collect():
        doc = json.loads(row["value"])
        assert doc["window"] == W
        assert row["collection"] == f"{doc['topic']}_300"
        found.setdefault(doc["topic"], []).append(doc)
    assert len(found) == 10
    assert len(found["openSessions"]) == 4
    (node,) = found["journeyNodesCount"]
    assert node == {
        "projectId": "p1",
        "channel": "web",
        "timeMark": T0 + W,
        "state": "validNode",
        "intentName": "i1",
        "previousStage": "s0",
        "stageName": 'say "hi"\\now',
        "count": 1,
        "window": W,
        "topic": "journeyNodesCount",
    }
    assert {d["channel"] for d in found["messageCount"]} == {"web", None}


def test_dry_run_counts_every_metric_in_one_query(spark):
    tables = metric_groups(sample(spark))
    got = {r["metric"]: r["documents"] for r in dry_run_counts(tables, W).collect()}
    assert got == {name: table.count() for name, table in tables.items()}


def test_kafka_frames(spark):
    docs = all_events_documents(sample(spark))
    plain = sinks.kafka_records(docs)
    assert plain.columns == ["topic", "value"]
    assert {r["topic"] for r in plain.collect()} == {"allEvents"}
    assert all(json.loads(r["value"])["topic"] == "allEvents" for r in plain.collect())
    stripped = sinks.kafka_records(docs, strip=True)
    assert not any("\\" in r["value"] for r in stripped.collect())
    keyed = sinks.keyed_kafka_records(docs.repartition(5), topic_partitions=2)
    assert keyed.columns == ["topic", "key", "value", "partition"]
    assert {r["partition"] for r in keyed.collect()} <= {0, 1}
    assert dict(keyed.dtypes)["partition"] == "int"
    with pytest.raises(ValueError):
        sinks.keyed_kafka_records(docs, 0)


def test_store_writes_one_collection_each(spark, tmp_path):
    table = metric_groups(sample(spark))["resp_type"]
    sinks.write_store(table, "respType_300", source="json", path=str(tmp_path))
    sinks.write_store(table, "respType_300", source="json", path=str(tmp_path))
    assert spark.read.json(str(tmp_path / "respType_300")).count() == 2 * table.count()


def test_fan_out_gives_every_sink_the_same_rows(spark):
    seen = []
    rows_in = sample(spark)
    sinks.fan_out(rows_in, [lambda d: seen.append(rows(d)), lambda d: seen.append(rows(d))])
    assert seen == [rows(rows_in)] * 2
    assert not rows_in.is_cached


def test_fan_out_lets_go_after_a_failure(spark):
    def broken(_):
        raise RuntimeError("sink down")

    df = sample(spark)
    with pytest.raises(RuntimeError, match="sink down"):
        sinks.fan_out(df, [broken, broken])
    assert not df.is_cached


def test_batch_files_replace_themselves(spark, tmp_path):
    docs = metric_documents(metric_groups(sample(spark), ["performance"]), W)
    for _ in range(2):
        sinks.write_batch_text(docs, str(tmp_path), 3)
    read = spark.read.text(str(tmp_path))
    assert read.count() == docs.count()
    assert {r[0] for r in read.select("collection").distinct().collect()} == {
        "respType_300",
        "dropOffIntentCount_300",
        "dropOffStageCount_300",
    }


def test_archives(spark, tmp_path):
    raw = spark.createDataFrame([("a",), ("",), (None,), ("not json",)], "value string")
    assert rows(raw_archive(raw)) == [("a",), ("not json",)]
    path = str(tmp_path / "raw")
    for _ in range(2):
        write_raw_archive(raw, path, batch_time_ms=T0, batch_id=1)
    read = spark.read.text(path)
    assert rows(read.select("value", "batch_time")) == [("a", T0), ("not json", T0)]

    store = str(tmp_path / "messages")
    write_archive(sample(spark), store, partition_by=("event_date", "projectId"))
    got = spark.read.parquet(store)
    assert got.count() == 2
    assert {"event_date", "projectId", "previousStage", "topic"} <= set(got.columns)
