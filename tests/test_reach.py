"""User counts against sets, and sketches that merge to what one pass over all would give."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from talktally import operators as op
from talktally.operators.reach import user_counts_of
from talktally.plans import build_state, read_user_sketches, write_user_sketches
from talktally.sources import read_lines, stream_lines, to_messages
from talktally.streaming import BatchJob, start_partial
from tests.helpers import T0, W, message, messages, rows
from tests.test_streaming import make_lines, run, write_files

DAY = 86_400_000


def some_messages(seed: int, count: int, users: int = 40) -> list[tuple]:
    draw = random.Random(seed)
    return [
        message(
            draw.randrange(-2 * DAY, 2 * DAY),
            seq,
            sender=draw.choice([None, "", "null", *(f"u{i}" for i in range(users))]),
            projectId=draw.choice(["p1", "p2"]),
            channel=draw.choice(["web", "", None]),
        )
        for seq in range(count)
    ]


def counted(made: list[tuple], keys, window: int) -> set[tuple]:
    seen: dict[tuple, set] = {}
    for project, channel, sender, *_, stamp, _ in made:
        mark = (stamp // window + 1) * window
        seen.setdefault(keys(project, channel, mark), set()).add((project, sender))
    return {(*key, len(users)) for key, users in seen.items()}


def test_counts_and_rollup(spark):
    made = some_messages(1, 900)
    table = messages(spark, *made)
    by_channel = counted(made, lambda p, c, m: (p, c, m), DAY)
    assert set(rows(op.user_counts(table, DAY))) == by_channel
    assert set(rows(user_counts_of(build_state(table, window_ms=DAY).users))) == by_channel
    want = {("channel", *r) for r in by_channel}
    want |= {("project", *r) for r in counted(made, lambda p, c, m: (p, None, m), DAY)}
    want |= {("all", *r) for r in counted(made, lambda p, c, m: (None, None, m), DAY)}
    got = op.user_rollup(table, DAY).select("level", "projectId", "channel", "timeMark", "users")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_no_messages(spark):
    none = messages(spark, message(0)).limit(0)
    for table in (op.user_counts(none), op.user_rollup(none), op.user_sketches(none)):
        assert table.count() == 0


@pytest.mark.parametrize("shift", [0, -T0])
def test_sketches_of_windows_give_longer_periods(spark, shift):
    made = [(*m[:-2], m[-2] + shift, m[-1]) for m in some_messages(2, 1500, users=200)]
    table = messages(spark, *made)
    exact = {(r[0], r[1], r[2]): r[3] for r in rows(op.user_counts(table, DAY))}
    for window in (W, DAY):
        about = op.users_over(op.user_sketches(table, window), window, DAY)
        got = {tuple(r[:3]): r[3] for r in rows(about)}
        assert got.keys() == exact.keys()
        assert all(abs(got[k] - n) <= 0.03 * n for k, n in exact.items())


def test_sketches_merge_in_any_order_and_again(spark):
    made = some_messages(3, 1200)
    table = messages(spark, *made).withColumn("part", F.pmod("seq", F.lit(5)))
    parts = op.user_sketches(table, W, ["part"])
    whole = op.users_over(op.user_sketches(table, W), W, W)
    once = op.merge_user_sketches(parts.orderBy(F.rand(4)))
    twice = op.merge_user_sketches(parts.drop("part").union(once).union(once))
    assert rows(op.users_over(once, W, W)) == rows(op.users_over(twice, W, W)) == rows(whole)
    # Over all channels, and over everything.
    by_project = {r[:2]: r[2] for r in rows(op.users_over(once, W, DAY, ["projectId"]))}
    exact = {(r[0], r[2]): r[3] for r in counted(made, lambda p, c, m: (p, None, m), DAY)}
    assert by_project.keys() == exact.keys()
    assert all(abs(by_project[k] - n) <= 0.03 * n for k, n in exact.items())
    assert len(rows(op.users_over(once, W, 10_000 * DAY, []))) == 1


def test_periods_are_whole_numbers_of_windows(spark):
    sketches = op.user_sketches(messages(spark, message(0)))
    for period in (W - 1, W + 1, 0):
        with pytest.raises(ValueError):
            op.users_over(sketches, W, period)


def test_stored_sketches_replace_a_retried_batch_and_read_dates(spark, tmp_path):
    table = messages(spark, *some_messages(5, 600))
    path = str(tmp_path / "reach")
    for batch, part in ((0, 0), (1, 1), (1, 1)):
        write_user_sketches(op.user_sketches(table.where(F.pmod("seq", F.lit(2)) == part)), path, W, batch)
    got = op.users_over(read_user_sketches(spark, path, W), W, DAY)
    assert rows(got) == rows(op.users_over(op.user_sketches(table), W, DAY))
    one_day = read_user_sketches(spark, path, W, "2024-01-01", "2024-01-01")
    marks = [r[0] for r in rows(one_day.select("timeMark").distinct())]
    assert marks and all(T0 < m <= T0 + DAY for m in marks)


def test_a_stream_stores_sketches(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    write_files(folder, make_lines(), 3)
    job = BatchJob(store, groups=(), keep_reach=True)
    run(start_partial(stream_lines(spark, folder, 1), job, str(tmp_path / "cp"), every=None))
    whole = to_messages(read_lines(spark, folder))
    stored = read_user_sketches(spark, f"{store}/reach", W)
    assert rows(op.users_over(stored, W, W)) == rows(op.user_counts(whole))
