"""How many users: exact counts, and sketches that merge over any longer period.

`distinct_users` lists the users of each window; these count them. Exact counts of longer
periods need the messages again, as a user of two windows is one user of both. A sketch
needs them once: it has a bounded size whatever it has seen, and those of windows, channels
or batches merge into the sketch of all of them, so that daily or monthly users follow from
stored windows, within about one percent.

A missing sender counts as one user, and a user of two projects as two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talktally.functions import time_mark
from talktally.functions.timing import release_bucket, with_bucket
from talktally.operators.users import _by_user, _finish, _keys
from talktally.schema import CHANNEL_KEYS, CHANNEL_WINDOW, DEFAULT_WINDOW_MS

# A sketch has up to 2**14 bytes and a standard error of some 0.8 percent.
SKETCH_BITS = 14
_CHANNEL_BUCKET = [*CHANNEL_KEYS, "bucket"]


def _user() -> Column:
    """The sender as text that differs from every other sender's, also where it is missing."""
    # Never empty, as sketches leave empty text out.
    return F.coalesce(F.concat(F.lit("u"), "senderId"), F.lit("n"))


def user_counts_of(users: DataFrame) -> DataFrame:
    """Users per project, channel and window, from a table of user windows."""
    counted = users.groupBy(*_keys(users, _CHANNEL_BUCKET)).agg(F.count(F.lit(1)).alias("users"))
    return _finish(counted)


def user_counts(messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Users per project, channel and window, of a table or a stream."""
    return user_counts_of(_by_user(messages, window_ms, ["messages"]))


def user_rollup(messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Users per window by channel, by project over its channels, and over all projects.

    level says which; columns that a row is summed over are null. Spark counts distinct
    users in two steps, by user first, so that a large project is spread over all tasks.
    """
    cut = with_bucket(messages, window_ms).withColumn("user", F.struct("projectId", _user()))
    sets = [["bucket", *CHANNEL_KEYS], ["bucket", "projectId"], ["bucket"]]
    levels = (
        F.when(F.grouping("projectId") == 1, "all")
        .when(F.grouping("channel") == 1, "project")
        .otherwise("channel")
    )
    counted = cut.groupingSets(sets, "bucket", *CHANNEL_KEYS).agg(
        levels.alias("level"), F.count_distinct("user").alias("users")
    )
    return release_bucket(counted)


def user_sketches(
    messages: DataFrame,
    window_ms: int = DEFAULT_WINDOW_MS,
    split_by: Sequence[str] = (),
    bits: int = SKETCH_BITS,
) -> DataFrame:
    """A sketch of the users of each project, channel and window.

    Sketches are made before the shuffle, so a project with a third of all messages sends
    one from each task. `split_by` keeps partial results apart.
    """
    cut = with_bucket(messages, window_ms)
    made = cut.groupBy(*_CHANNEL_BUCKET, *split_by).agg(
        F.hll_sketch_agg(_user(), bits).alias("sketch")
    )
    return release_bucket(made)


def merge_user_sketches(partials: DataFrame, by: Sequence[str] = CHANNEL_WINDOW) -> DataFrame:
    """One sketch for each key; merging again, or in any order, changes nothing."""
    return partials.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def users_over(
    sketches: DataFrame,
    window_ms: int,
    period_ms: int,
    by: Sequence[str] = CHANNEL_KEYS,
) -> DataFrame:
    """About how many users each period had, by the columns named.

    A period is a whole number of windows and is named by its exclusive end, as a window is.
    To count over all channels leave them out of `by`; over all projects a sender who is
    in two of them then counts once.
    """
    if period_ms < window_ms or period_ms % window_ms:
        raise ValueError(f"period_ms must be a multiple of window_ms, got {period_ms}")
    # All stamps of a window are in the period of this one, around 1970 too.
    start = F.col("timeMark") - window_ms
    periods = sketches.withColumn("timeMark", time_mark(start, period_ms))
    merged = merge_user_sketches(periods, [*by, "timeMark"])
    return merged.select(*by, "timeMark", F.hll_sketch_estimate("sketch").alias("users"))
