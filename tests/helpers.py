"""Small hand-made inputs."""

from __future__ import annotations

import json

from talktally.functions import event_time
from talktally.plans import metric_documents

T0 = 1_704_067_200_000
W = 300_000
SCHEMA = (
    "projectId string, channel string, senderId string, status string, "
    "prevConversationType string, previousStageName string, intentName string, "
    "intentDetected string, stageName string, timestamp bigint, seq bigint"
)


def message(at: int, seq: int = 0, sender: str | None = "u1", **fields) -> tuple:
    values = {
        "projectId": "p1",
        "channel": "web",
        "status": "cancel",
        "prevConversationType": "flow",
        "previousStageName": "s0",
        "intentName": "i1",
        "intentDetected": "d1",
        "stageName": "s1",
    } | fields
    return (
        values["projectId"],
        values["channel"],
        sender,
        values["status"],
        values["prevConversationType"],
        values["previousStageName"],
        values["intentName"],
        values["intentDetected"],
        values["stageName"],
        T0 + at,
        seq,
    )


def messages(spark, *rows: tuple):
    return spark.createDataFrame(list(rows), SCHEMA).withColumn(
        "eventTime", event_time("timestamp")
    )


def event(at: int = 0, **changes) -> dict:
    """A raw event as it comes from the topic."""
    base = {
        "projectId": "p1",
        "filterCode": "web",
        "senderId": "u1",
        "payload": {
            "status": {"final": "nextStart", "prevConversation": "flow", "previousStage": "s0"}
        },
        "conversationId": "i1",
        "intentName": "d1",
        "stageName": "s1",
        "timestamp": T0 + at,
        "requestAssistance": False,
    }
    return {k: v for k, v in (base | changes).items() if v is not ...}


def line(at: int = 0, **changes) -> str:
    return json.dumps(event(at, **changes))


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def assert_same_metrics(tables: dict, expected: dict, window_ms: int = W) -> None:
    """Both sets of metrics give the same documents; one query for each set."""
    assert tables.keys() == expected.keys()
    got, want = (rows(metric_documents(t, window_ms)) for t in (tables, expected))
    assert got == want
