"""Stored state: batches replace themselves, merge, prune by date and compact."""

from __future__ import annotations

import datetime

import pytest

from talktally.plans import (
    build_state,
    compact_state,
    metric_groups,
    metrics_of,
    read_state,
    write_state,
)
from talktally.plans.state import window_date
from tests.helpers import T0, W, assert_same_metrics, message, messages

DAY = 86_400_000
GAP = 1000


def sample(spark):
    return messages(
        spark,
        message(0, 0, intentName="a"),
        message(500, 1, intentName="b"),
        message(1600, 2, stageName=None),
        message(2500, 3, status="nextStart"),
        message(2600, 4, sender=None, channel=None),
        message(2 * DAY, 5, sender="late"),
    )


def write_two_batches(spark, path, m):
    for batch in (0, 1):
        part = m.filter(f"seq % 2 = {batch}")
        write_state(build_state(part, gap_ms=GAP), path, batch, gather_dates=batch == 0)


def test_batches_that_split_a_users_window_merge(spark, tmp_path):
    m, path = sample(spark), str(tmp_path / "s")
    write_two_batches(spark, path, m)
    # Again, as a retry would; the same batches must not count twice.
    write_two_batches(spark, path, m)
    assert_same_metrics(metrics_of(read_state(spark, path, gap_ms=GAP)), metric_groups(m, gap_ms=GAP))


def test_one_batch_is_whole_without_a_merge(spark, tmp_path):
    m, path = sample(spark), str(tmp_path / "s")
    write_state(build_state(m, gap_ms=GAP), path, 4)
    state = read_state(spark, path, gap_ms=GAP, batch_id=4)
    assert_same_metrics(metrics_of(state), metric_groups(m, gap_ms=GAP))
    assert "Exchange" not in state.users._jdf.queryExecution().toString()


def test_compacted_state_gives_the_same_metrics(spark, tmp_path):
    m, path = sample(spark), str(tmp_path / "s")
    write_two_batches(spark, path, m)
    state = compact_state(spark, path, str(tmp_path / "c"), gap_ms=GAP)
    assert_same_metrics(metrics_of(state), metric_groups(m, gap_ms=GAP))


def test_dates_bound_what_is_read(spark, tmp_path):
    m, path = sample(spark), str(tmp_path / "s")
    write_two_batches(spark, path, m)
    first = read_state(spark, path, gap_ms=GAP, to_date="2024-01-02")
    expected = metric_groups(m.filter(f"timestamp < {T0 + DAY}"), gap_ms=GAP)
    assert_same_metrics(metrics_of(first), expected)
    rest = read_state(spark, path, gap_ms=GAP, from_date="2024-01-02")
    assert [r["senderId"] for r in rest.users.collect()] == ["late"]


def test_state_of_other_settings_stays_apart(spark, tmp_path):
    m, path = sample(spark), str(tmp_path / "s")
    write_state(build_state(m, gap_ms=GAP), path)
    write_state(build_state(m, window_ms=DAY, gap_ms=GAP), path)
    assert_same_metrics(metrics_of(read_state(spark, path, gap_ms=GAP)), metric_groups(m, gap_ms=GAP))
    assert_same_metrics(
        metrics_of(read_state(spark, path, DAY, GAP)),
        metric_groups(m, window_ms=DAY, gap_ms=GAP),
        DAY,
    )


@pytest.mark.parametrize("group", ["engagement", "performance", "detailed"])
def test_one_group_stores_only_its_own(spark, tmp_path, group):
    m, path = sample(spark), str(tmp_path / "s")
    write_state(build_state(m, [group], gap_ms=GAP), path)
    state = read_state(spark, path, gap_ms=GAP, groups=[group])
    assert_same_metrics(metrics_of(state, [group]), metric_groups(m, [group], gap_ms=GAP))


def test_an_empty_store_reads_as_empty(spark, tmp_path):
    state = build_state(sample(spark).filter("false"))
    write_state(state, str(tmp_path / "s"))
    got = read_state(spark, str(tmp_path / "s"), like=state)
    assert all(t.count() == 0 for t in metrics_of(got).values())


def test_unknown_group_is_refused(spark):
    with pytest.raises(ValueError, match="unknown metric groups"):
        build_state(sample(spark), ["other"])


def test_far_timestamps_are_stored_and_read_back(spark, tmp_path):
    far = 9_000_000_000_000_000 - T0
    m, path = messages(spark, message(far), message(-far - 2 * T0), message(0)), str(tmp_path)
    write_state(build_state(m, gap_ms=GAP), path)
    state = read_state(spark, path, gap_ms=GAP)
    assert_same_metrics(metrics_of(state), metric_groups(m, gap_ms=GAP))
    assert read_state(spark, path, gap_ms=GAP, to_date="2024-06-01").users.count() == 2


def test_window_date_is_the_utc_date_of_the_start(spark):
    df = spark.createDataFrame([(T0,), (T0 + W,), (T0 + DAY,), (W - 1,)], "mark bigint")
    got = [r[0] for r in df.select(window_date("mark", W)).collect()]
    jan = datetime.date(2024, 1, 1)
    day = datetime.timedelta(days=1)
    assert got == [jan - day, jan, jan, datetime.date(1969, 12, 31)]
