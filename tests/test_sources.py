"""Raw lines to messages: what is kept, dropped and quarantined."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from talktally import operators as op
from talktally.sources import (
    events_as_messages,
    parse_events,
    quarantined,
    read_lines,
    stream_lines,
    to_messages,
    usable,
)
from talktally.sources import kafka
from tests.helpers import T0, W, event, line, rows


def raw(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, seq int")


def test_names_shift_from_json_to_message(spark):
    got = to_messages(raw(spark, line())).first().asDict()
    assert got["channel"] == "web"
    assert got["status"] == "nextStart"
    assert got["prevConversationType"] == "flow"
    assert got["previousStageName"] == "s0"
    assert got["intentName"] == "i1"
    assert got["intentDetected"] == "d1"
    assert got["timestamp"] == T0
    assert "humanSupport" not in got


def test_empty_lines_and_tombstones_are_dropped(spark):
    assert parse_events(raw(spark, "", None, line())).count() == 1


def test_arrays_give_one_event_each(spark):
    array = json.dumps([event(), event(1), event(2)])
    got = to_messages(raw(spark, array, line(3), "[]"))
    assert sorted(r["timestamp"] - T0 for r in got.collect()) == [0, 1, 2, 3]
    assert got.select("seq").distinct().count() == 4


@pytest.mark.parametrize(
    ("assistance", "kept"),
    [(False, 1), ("false", 1), (True, 0), ("true", 0), ("", 1), ("EMPTY", 1), (None, 1), (..., 1)],
)
def test_bot_messages_by_request_assistance(spark, assistance, kept):
    assert to_messages(raw(spark, line(requestAssistance=assistance))).count() == kept


@pytest.mark.parametrize("project", ["", "EMPTY", None, ...])
def test_messages_without_a_project_are_dropped(spark, project):
    assert to_messages(raw(spark, line(projectId=project))).count() == 0


def test_payload_absent_or_text_leaves_the_rest(spark):
    got = to_messages(raw(spark, line(payload=...), line(payload="x"), line(payload=None)))
    assert [(r["status"], r["intentName"]) for r in got.collect()] == [(None, "i1")] * 3


def test_bad_lines_are_quarantined_not_fatal(spark):
    bad = ['{"projectId":"p', "plain text", line(timestamp="soon"), line(timestamp=...)]
    human = line(timestamp="soon", requestAssistance=True)
    events = parse_events(raw(spark, *bad, human, line()))
    assert usable(events).count() == 1
    got = {r["value"]: r["reason"] for r in quarantined(events).collect()}
    assert got == dict(zip(bad, ["malformed"] * 2 + ["bad_timestamp"] * 2, strict=True))


def test_timestamps_too_large_for_a_time_mark_are_quarantined(spark):
    largest = 9_200_000_000_000_000_000
    lines = [line(timestamp=t) for t in (2**63 - 1, -(2**63), 2**63, largest, -largest)]
    events = parse_events(raw(spark, *lines))
    assert rows(usable(events).select("timestamp")) == [(-largest,), (largest,)]
    assert sorted(r["value"] for r in quarantined(events).collect()) == sorted(lines[:3])


def test_timestamps_beyond_a_clock_count_all_the_same(spark):
    far = 9_000_000_000_000_001
    found = to_messages(raw(spark, line(timestamp=far), line(timestamp=-far)))
    assert rows(found.select("timestamp", "eventTime")) == [(-far, None), (far, None)]
    marks = rows(op.message_count(found).select("timeMark", "count"))
    assert marks == [(-(far // W) * W + W, 1), (far // W * W + W, 1)]


def test_the_last_of_a_repeated_key_holds_in_both_parses(spark):
    twice = line().replace('"projectId"', '"projectId": "p0", "projectId"', 1)
    for any_case in (False, True):
        found = to_messages(raw(spark, twice), any_key_case=any_case).first()
        assert found["projectId"] == event()["projectId"]


def test_any_key_case_parses_each_nested_object_once(spark):
    events = parse_events(raw(spark, line()), any_key_case=True)
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 4


def test_good_rows_do_not_carry_their_text(spark):
    got = parse_events(raw(spark, line(), "broken")).select("malformed", "value").collect()
    assert sorted(map(tuple, got)) == [(False, None), (True, "broken")]


def test_timestamp_as_text_or_number(spark):
    got = to_messages(raw(spark, line(timestamp=str(T0)), line(timestamp=T0)))
    assert [r["timestamp"] for r in got.collect()] == [T0, T0]


def test_missing_default_fills_absent_fields(spark):
    got = to_messages(raw(spark, line(filterCode=...)), missing_default="").first()
    assert got["channel"] == ""
    assert to_messages(raw(spark, line(filterCode=...))).first()["channel"] is None


def test_any_key_case(spark):
    odd = event()
    odd["PROJECTID"] = odd.pop("projectId")
    odd["Payload"] = {"STATUS": {"Final": "cancel"}}
    del odd["payload"]
    values = [json.dumps(odd), json.dumps([odd, event()]), "nonsense", line(payload="x"), "[]"]
    assert to_messages(raw(spark, values[0])).count() == 0
    events = parse_events(raw(spark, *values), any_key_case=True)
    got = sorted(str(r["status"]) for r in usable(events).collect())
    assert got == ["None", "cancel", "cancel", "nextStart"]
    assert [r["value"] for r in quarantined(events).collect()] == ["nonsense"]


def test_any_key_case_changes_nothing_for_exact_keys(spark):
    lines = raw(spark, line(), line(1, senderId=None), line(2, payload={"status": {}}))
    assert to_messages(lines).exceptAll(to_messages(lines, any_key_case=True)).count() == 0


def test_file_lines_get_the_same_seq_however_they_are_split(spark, tmp_path):
    values = [(line(i),) for i in range(50)]
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    df = spark.createDataFrame(values, "value string")
    df.coalesce(1).write.text(one)
    df.repartition(7).write.text(many)
    assert read_lines(spark, one).exceptAll(read_lines(spark, many)).count() == 0
    assert stream_lines(spark, one, max_files_per_trigger=1).isStreaming


def test_kafka_records_become_raw_lines(spark):
    records = spark.createDataFrame(
        [(bytearray(line().encode()), "t", 3, 7), (None, "t", 3, 8)],
        "value binary, topic string, partition int, offset bigint",
    )
    got = to_messages(kafka.raw_lines(records)).first()
    assert got["seq"]["seq"].asDict() == {"topic": "t", "partition": 3, "offset": 7}


def test_kafka_options():
    options = kafka._options("h:1", ["a", "b"], "latest", {"failOnDataLoss": "false"})
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }


def test_events_table_reads_zoned_timestamps_too(spark):
    ntz = spark.sql(
        "SELECT 5L AS event_id, timestamp_ntz'2024-01-01 00:00:00.123456' AS ts, 3L AS user_id, "
        "'click' AS event_type, '{\"k\": 4}' AS props"
    )
    zoned = ntz.withColumn("ts", F.timestamp_micros(F.lit(T0 * 1000 + 123_456)))
    assert events_as_messages(ntz).collect() == events_as_messages(zoned).collect()
    assert events_as_messages(ntz).first()["timestamp"] == T0 + 123
