"""Compacted stores equal one run over all messages, whatever was late or stopped half way."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from talktally.plans import CompactedStore, build_state, metric_groups, metrics_of, write_state
from talktally.plans import compaction
from talktally.sources import read_lines, stream_lines, to_messages
from talktally.streaming import BatchJob, start_partial
from tests.helpers import T0, W, assert_same_metrics, message, messages
from tests.test_streaming import make_lines, run, write_files

DAY = 86_400_000
GAP = 1_800_000
GROUPS = ("engagement",)  # whose metrics follow from all three tables
SETTINGS = {"window_ms": DAY, "gap_ms": GAP}


def some_messages(seed: int, days: range, count: int, first_seq: int) -> list[tuple]:
    draw = random.Random(seed)
    return [
        message(
            draw.choice(days) * DAY + draw.randrange(DAY),
            first_seq + i,
            sender=draw.choice(["a", "b", None]),
            channel=draw.choice(["web", None]),
            status=draw.choice(["nextStart", "inFlowNextValidated", "inFlowNextGhost", None]),
            intentName=draw.choice(["i1", "i2", None]),
        )
        for i in range(count)
    ]


# Batches by the days that they touch; the fourth is late and the fifth has no message.
BATCHES = [range(0, 2), range(1, 3), range(3, 4), range(0, 1), range(0), range(3, 5)]


def batches(spark) -> list:
    return [
        messages(spark, *some_messages(n, days, 25, 100 * n)) if len(days) else messages(spark, message(0)).limit(0)
        for n, days in enumerate(BATCHES)
    ]


def store_of(tmp_path, like) -> CompactedStore:
    return CompactedStore(str(tmp_path / "live"), str(tmp_path / "compacted"), build_state(like, GROUPS, **SETTINGS))


def expected(parts) -> dict:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return metric_groups(whole, GROUPS, **SETTINGS)


def dates_of(spark, store, generation: int) -> list[str]:
    rows = store._newest(spark).where(F.col("batch_id") == generation).collect()
    return sorted(str(r["event_date"]) for r in rows)


def test_compactions_between_batches(spark, tmp_path):
    parts = batches(spark)
    store = store_of(tmp_path, parts[0])
    done = []
    for n, part in enumerate(parts):
        write_state(build_state(part, GROUPS, **SETTINGS), store.live, n)
        if n in (1, 3, 5):
            done.append(store.compact(spark))
            assert_same_metrics(metrics_of(store.read(spark), GROUPS), expected(parts[: n + 1]), DAY)
    # All but the newest batch each time, the empty one among them.
    assert done == [0, 2, 4]
    # The late batch has rewritten its own date alone.
    assert dates_of(spark, store, 4) == ["2024-01-01"]
    assert dates_of(spark, store, 2) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    assert store.compact(spark, upto=5) == 5 == store.compact(spark)
    live = spark.read.parquet(f"{store.live}/users")
    assert live.where("batch_id > 5").count() == 0
    assert_same_metrics(metrics_of(store.read(spark), GROUPS), expected(parts), DAY)


def test_a_compaction_that_stopped_is_done_again(spark, tmp_path, monkeypatch):
    parts = batches(spark)
    store = store_of(tmp_path, parts[0])
    for n in range(3):
        write_state(build_state(parts[n], GROUPS, **SETTINGS), store.live, n)
    assert store.compact(spark, upto=0) == 0

    def stopped(state, path, batch_id=0, **options):
        if batch_id == 1:
            write_state(state, path, batch_id, **options)
            raise RuntimeError("stopped before the list was written")
        write_state(state, path, batch_id, **options)

    monkeypatch.setattr(compaction, "write_state", stopped)
    with pytest.raises(RuntimeError):
        store.compact(spark, upto=1)
    monkeypatch.undo()
    assert_same_metrics(metrics_of(store.read(spark), GROUPS), expected(parts[:3]), DAY)
    # The same batches again, or more of them.
    assert store.compact(spark, upto=2) == 2
    assert_same_metrics(metrics_of(store.read(spark), GROUPS), expected(parts[:3]), DAY)


def test_dates_and_empty_stores(spark, tmp_path):
    parts = batches(spark)
    store = store_of(tmp_path, parts[0])
    write_state(build_state(parts[4], GROUPS, **SETTINGS), store.live, 0)
    assert store.compact(spark) == -1
    assert store.read(spark).users.count() == 0
    write_state(build_state(parts[0], GROUPS, **SETTINGS), store.live, 1)
    write_state(build_state(parts[1], GROUPS, **SETTINGS), store.live, 2)
    assert store.compact(spark) == 1
    one = parts[0].unionByName(parts[1]).where(F.col("timestamp").between(T0 + DAY, T0 + 2 * DAY - 1))
    got = store.read(spark, "2024-01-02", "2024-01-02")
    assert_same_metrics(metrics_of(got, GROUPS), metric_groups(one, GROUPS, **SETTINGS), DAY)


def test_a_stream_compacts_its_batches(spark, tmp_path):
    folder, home = str(tmp_path / "in"), str(tmp_path / "store")
    write_files(folder, make_lines(), 5)
    job = BatchJob(home, groups=("performance",), compact_every=2)
    run(start_partial(stream_lines(spark, folder, 1), job, str(tmp_path / "cp"), every=None))
    whole = to_messages(read_lines(spark, folder))
    like = build_state(whole, ("performance",))
    store = CompactedStore(f"{home}/state", f"{home}/compacted", like)
    assert store._last(spark) == 3
    got = metrics_of(store.read(spark), ("performance",))
    assert_same_metrics(got, metric_groups(whole, ["performance"]), W)
