"""What Spark plans: pruning, partial aggregation, no raw rows in windows or lists."""

from __future__ import annotations

import contextlib
import io

from talktally import catalog
from talktally import operators as op
from talktally.plans import build_state, write_archive
from talktally.sources import events_as_messages
from tests.conftest import SF_DIR
from tests.helpers import message, messages

DAY = 86_400_000


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_no_python_in_any_batch_query(spark):
    for name, query in catalog.all_queries().items():
        if not name.startswith(("stream_", "stored_")):
            text = plan(query(spark, SF_DIR))
            assert "Python" not in text and "Pandas" not in text, name
            assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_scans_read_only_needed_columns(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(op.message_count(events_as_messages(events)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text


def test_counts_aggregate_before_the_shuffle(spark):
    text = plan(op.message_counts(messages(spark, message(0))))
    assert text.count("Exchange") == 2  # one in the tree, one in the details
    assert "partial_count" in text


def test_numbers_use_hash_aggregation(spark):
    m = messages(spark, message(0))
    for table in (op.time_spent(m), op.distinct_users(m), op.session_count(m, gap_ms=1000)):
        assert "SortAggregate" not in plan(table)


def test_argmax_needs_no_window_and_merges_before_the_shuffle(spark):
    m = messages(spark, message(0))
    for table in (op.open_sessions_last(m), op.drop_off_intent(m), op.drop_off_stage(m)):
        text = plan(table)
        assert "Window" not in text and "partial_m" in text


def test_session_windows_see_slices_only(spark):
    text = plan(op.session_count(messages(spark, message(0)), gap_ms=1000))
    tree = text[: text.index("\n\n\n")]
    below_window = tree[tree.index("Window") :]
    # Above the scan, rows are reduced to slices before and after the first shuffle.
    assert below_window.count("HashAggregate") == 2
    assert below_window.count("Exchange") == 2
    assert "collect_list" not in text


def test_unused_state_is_pruned(spark):
    state = build_state(messages(spark, message(0)))
    text = plan(state.users.groupBy("projectId").count())
    assert "first_event" not in text and "last_stage" not in text


def test_triggers_push_their_status_test_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    messages(spark, message(0)).write.parquet(path)
    text = plan(op.intent_triggers(spark.read.parquet(path)))
    assert "In(status, [inFlowNextGhost,nextStart])" in text
    assert "IsNotNull(prevConversationType)" in plan(op.journey_nodes(spark.read.parquet(path)))


def test_archive_reads_prune_dates(spark, tmp_path):
    path = str(tmp_path / "archive")
    write_archive(messages(spark, message(0), message(2 * DAY)), path)
    read = spark.read.parquet(path).filter("event_date = DATE'2024-01-01'")
    assert read.count() == 1
    assert "PartitionFilters: [isnotnull(event_date" in plan(read)
