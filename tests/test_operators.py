"""Metrics on hand-made messages, and properties that hold for any messages."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from talktally import catalog
from talktally import operators as op
from talktally.plans import build_state, metric_groups, metrics_of
from talktally.plans.state import merge_state
from tests.conftest import SF_DIR
from tests.helpers import SCHEMA, T0, W, assert_same_metrics, message, messages, rows

MARK = T0 + W
DAY = 86_400_000


def test_window_edges(spark):
    m = messages(spark, message(0), message(W - 1), message(W))
    assert rows(op.message_count(m)) == [("p1", "web", MARK, 2), ("p1", "web", MARK + W, 1)]


def test_null_channel_and_null_sender_are_keys(spark):
    m = messages(
        spark,
        message(0, sender=None, channel=None),
        message(1, sender=None, channel=None),
        message(2, sender="u", channel=""),
    )
    assert rows(op.distinct_users(m)) == [
        ("p1", "", MARK, "u"),
        ("p1", None, MARK, None),
    ]


def test_time_spent_sums_over_users(spark):
    m = messages(spark, message(0), message(5), message(9), message(0, sender="b"))
    assert rows(op.time_spent(m)) == [("p1", "web", MARK, 9)]
    assert rows(op.time_spent(m, max_span_ms=8)) == [("p1", "web", MARK, 0)]


def test_sessions_equal_users_when_the_gap_is_the_window(spark):
    m = messages(spark, message(0), message(W - 1), message(3, sender="b"))
    assert rows(op.session_count(m)) == [("p1", "web", MARK, 2)]


@pytest.mark.parametrize(
    ("times", "gap", "sessions"),
    [
        ([0], 1000, 1),
        ([0, 1000], 1000, 1),
        ([0, 1000, 2001], 1000, 2),
        ([0, 999, 1998, 2997], 1000, 1),
        ([0, 0, 0], 0, 1),
        ([0, 1, 3], 0, 3),
        ([999, 1999, 3000, 5000], 1000, 3),
    ],
)
def test_sessions_break_only_beyond_the_gap(spark, times, gap, sessions):
    m = messages(spark, *[message(t, i) for i, t in enumerate(times)])
    assert rows(op.session_count(m, gap_ms=gap)) == [("p1", "web", MARK, sessions)]


def test_sessions_before_1970(spark):
    m = messages(spark, *[message(-T0 + t) for t in (-900, -100, 100, 1101)])
    assert rows(op.session_count(m, gap_ms=1000)) == [("p1", "web", W, 2)]


@pytest.mark.parametrize("gap", [1, 7, 50, 1000, 20_000])
def test_sessions_equal_brute_force_in_many_rounds(spark, gap, monkeypatch):
    monkeypatch.setattr("talktally.operators.sessions.FAN_IN", 4)
    draw = random.Random(gap)
    times = {
        user: sorted(draw.randrange(W) for _ in range(draw.randrange(1, 60)))
        for user in ("a", "b", None)
    }
    m = messages(spark, *[message(t, sender=u) for u, ts in times.items() for t in ts])
    expected = sum(
        1 + sum(b - a > gap for a, b in zip(ts, ts[1:])) for ts in times.values()
    )
    assert rows(op.session_count(m, gap_ms=gap)) == [("p1", "web", MARK, expected)]


def test_negative_gap_is_refused(spark):
    with pytest.raises(ValueError):
        op.session_count(messages(spark, message(0)), gap_ms=-1)


def test_last_intent_skips_messages_without_one(spark):
    m = messages(
        spark,
        message(0, intentName="a"),
        message(1, intentName="b"),
        message(2, intentName="EMPTY"),
        message(3, intentName=None),
        message(0, sender="x", intentName=""),
    )
    assert rows(op.drop_off_intent(m)) == [("p1", "web", MARK, "b", 1)]


def test_last_stage_keeps_empty_text_but_not_null(spark):
    m = messages(
        spark,
        message(0, stageName="s"),
        message(1, stageName=""),
        message(2, stageName=None),
        message(0, sender="b", stageName=None),
        message(0, sender="c", stageName="EMPTY"),
    )
    assert rows(op.drop_off_stage(m)) == [
        ("p1", "web", MARK, "i1", "", 1),
        ("p1", "web", MARK, "i1", "EMPTY", 1),
    ]


def test_ties_go_by_seq_and_not_by_row_order(spark):
    tied = [message(5, seq, status=f"s{seq}", intentName=f"i{seq}") for seq in range(6)]
    for _ in range(3):
        random.shuffle(tied)
        m = messages(spark, *tied).repartition(3)
        assert op.open_sessions_last(m).first()["status"] == "s5"
        assert op.open_sessions_first(m).first()["status"] == "s0"
        assert op.drop_off_intent(m).first()["intentName"] == "i5"


def test_open_sessions_drop_stale_users(spark):
    m = messages(spark, message(0), message(W - 10, sender="late"))
    assert [r["senderId"] for r in op.open_sessions_last(m, max_age_ms=10).collect()] == ["late"]
    assert op.open_sessions_last(m).count() == 2


def test_journey_nodes_need_every_part(spark):
    good = {"status": "inFlowNextValidated"}
    m = messages(
        spark,
        message(0, **good),
        message(1, status="inFlowNextInvalidated"),
        message(2, **good, prevConversationType="faq"),
        message(3, **good, previousStageName=""),
        message(4, **good, stageName=None),
        message(5, **good, intentName="EMPTY"),
        message(6, status=None),
        message(7),
    )
    assert rows(op.journey_nodes(m)) == [
        ("p1", "web", MARK, "invalidNode", "i1", "s0", "s1", 1),
        ("p1", "web", MARK, "validNode", "i1", "s0", "s1", 1),
    ]


def test_intent_triggers_by_ghost_column(spark):
    m = messages(
        spark,
        message(0, status="nextStart"),
        message(1, status="inFlowNextGhost"),
        message(2, status="inFlowNextGhost", stageName=None, intentDetected=None),
    )
    assert rows(op.intent_triggers(m)) == [
        ("p1", "web", MARK, "i1", 1),
        ("p1", "web", MARK, "s1", 1),
    ]
    assert rows(op.intent_triggers(m, ghost_col="intentDetected")) == [
        ("p1", "web", MARK, "d1", 1),
        ("p1", "web", MARK, "i1", 1),
    ]


def test_every_metric_of_no_messages_is_empty(spark):
    m = messages(spark, message(0)).filter("false")
    tables = metric_groups(m, gap_ms=1000) | metrics_of(build_state(m, gap_ms=1000))
    assert all(table.count() == 0 for table in tables.values())


def _total(df, column="count"):
    return df.agg(F.sum(column)).first()[0]


@pytest.mark.parametrize("window", [W, DAY])
def test_totals_agree(spark, window):
    m = catalog.messages(spark, SF_DIR)
    t = metric_groups(m, window_ms=window)
    users = t["distinct_users"].count()
    assert _total(t["message_count"]) == _total(t["resp_type"]) == m.count()
    assert users == t["open_sessions_last"].count() == t["open_sessions_first"].count()
    assert _total(t["session_count"]) == users
    assert _total(op.session_count(m, window, window // 10)) >= users
    assert _total(t["drop_off_stage"]) <= _total(t["drop_off_intent"]) <= users
    assert t["time_spent"].filter("totalTime < 0").count() == 0


def test_a_hot_user_merges_from_any_split(spark):
    """A third of all messages from one user, state split in many partial pieces."""
    draw = random.Random(3)
    made = [
        message(
            draw.randrange(DAY),
            i,
            sender=None if i % 3 == 0 else f"u{draw.randrange(40)}",
            status=draw.choice(["nextStart", "inFlowNextValidated", "inFlowNextGhost", None]),
            intentName=draw.choice(["a", "b", "", None]),
            stageName=draw.choice(["x", "y", "", None]),
        )
        for i in range(900)
    ]
    m = messages(spark, *made)
    gap = 600_000
    direct = metric_groups(m, window_ms=DAY, gap_ms=gap)
    for pieces in (1, 7):
        split = m.withColumn("piece", F.pmod(F.xxhash64("seq"), F.lit(pieces)))
        state = merge_state(
            build_state(split, window_ms=DAY, gap_ms=gap, split_by=("piece",))
        )
        assert_same_metrics(metrics_of(state), direct, DAY)


def test_schema_of_helpers_matches_the_canonical_columns(spark):
    assert set(catalog.messages(spark, SF_DIR).columns) == {
        part.split()[0] for part in SCHEMA.split(", ")
    } | {"eventTime"}


@pytest.mark.parametrize(("gap", "sessions"), [(W, 2), (W + 1, 2), (2 * W - 1, 1), (W - 1, 2)])
def test_the_window_around_1970_is_two_long(spark, gap, sessions):
    times = (-W + 1, W - 1)
    found = messages(spark, *[message(-T0 + t) for t in times])
    assert [r["count"] for r in op.session_count(found, gap_ms=gap).collect()] == [sessions]
    split = found.withColumn("batch", F.col("timestamp") < 0)
    state = merge_state(build_state(split, gap_ms=gap, split_by=("batch",)))
    assert [r["count"] for r in metrics_of(state)["session_count"].collect()] == [sessions]
