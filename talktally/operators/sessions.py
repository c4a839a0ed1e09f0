"""Sessions: a user's messages with no silence longer than the gap.

Each user's window is cut into slices as long as the gap. Two messages in one
slice can never be more than the gap apart, so a slice needs only its first and
last timestamp, and sessions break only between slices. No task ever holds all
messages of one user: slices are aggregated before the shuffle and a user's window
has at most window / gap of them. If that is still many, slices are merged in
rounds of `FAN_IN`. Slices also merge across batches, by min and max.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talktally.functions.timing import release_bucket, with_bucket
from talktally.operators.users import AROUND_1970, _by_user, long_gap_sessions_of
from talktally.schema import CHANNEL_KEYS, DEFAULT_WINDOW_MS

FAN_IN = 1024
_USER_BUCKET = [*CHANNEL_KEYS, "bucket", "senderId"]
_CHANNEL_BUCKET = [*CHANNEL_KEYS, "bucket"]
_SLICE = ["slice", "first_ts", "last_ts"]


def _slice_start(timestamp: str, slice_ms: int) -> Column:
    return F.col(timestamp) - F.pmod(F.col(timestamp), F.lit(slice_ms).cast("bigint"))


def _slices(messages: DataFrame, window_ms: int, gap_ms: int, extra: Sequence[str] = ()):
    # Negative gaps would split a session from itself.
    if gap_ms < 0:
        raise ValueError(f"gap_ms must not be negative, got {gap_ms}")
    cut = with_bucket(messages, window_ms).withColumn(
        "slice", _slice_start("timestamp", max(gap_ms, 1))
    )
    return cut.groupBy(*_USER_BUCKET, *extra, "slice").agg(
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")
    )


def session_slices(
    messages: DataFrame,
    window_ms: int = DEFAULT_WINDOW_MS,
    gap_ms: int | None = None,
    split_by: Sequence[str] = (),
) -> DataFrame:
    """The mergeable state of session counting."""
    gap = window_ms if gap_ms is None else gap_ms
    return release_bucket(_slices(messages, window_ms, gap, split_by))


def merge_session_slices(partials: DataFrame) -> DataFrame:
    keys = [c for c in partials.columns if c in ("projectId", "channel", "timeMark", "senderId")]
    return partials.groupBy(*keys, "slice").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )


def _join_slices(df: DataFrame, keys: list[str], gap_ms: int) -> DataFrame:
    """Merge the ordered slices of each key into one, counting breaks between them."""
    if df.isStreaming:
        return _join_slices_in_array(df, keys, gap_ms)
    # Led by a hash, the sort compares one number instead of four keys.
    led = ["key_hash", *keys]
    order = Window.partitionBy(*led).orderBy("first_ts")
    before = F.lag("last_ts").over(order)
    broken = F.when(F.col("first_ts") - before > gap_ms, 1).otherwise(0)
    return (
        df.withColumn("key_hash", F.xxhash64(*keys))
        .withColumn("breaks", F.col("breaks") + broken)
        .groupBy(*led)
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("breaks").alias("breaks"),
        )
        .drop("key_hash")
    )


def _join_slices_in_array(df: DataFrame, keys: list[str], gap_ms: int) -> DataFrame:
    # A stream has no lag(). At most FAN_IN slices meet here, so an array is safe.
    listed = df.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("first_ts", "last_ts", "breaks"))).alias("parts")
    )
    start = F.struct(
        F.col("parts")[0]["first_ts"].alias("last_ts"), F.lit(0).cast("bigint").alias("breaks")
    )

    def step(done: Column, part: Column) -> Column:
        broken = F.when(part["first_ts"] - done["last_ts"] > gap_ms, 1).otherwise(0)
        return F.struct(
            part["last_ts"].alias("last_ts"),
            (done["breaks"] + part["breaks"] + broken).alias("breaks"),
        )

    joined = listed.withColumn("joined", F.aggregate("parts", start, step))
    return joined.select(
        *keys,
        F.col("parts")[0]["first_ts"].alias("first_ts"),
        F.col("joined.last_ts").alias("last_ts"),
        F.col("joined.breaks").alias("breaks"),
    )


def _sessions_of_slices(slices: DataFrame, window_ms: int, gap_ms: int) -> DataFrame:
    df = slices.withColumn("breaks", F.lit(0).cast("bigint"))
    width = max(gap_ms, 1)
    # The window around 1970 is two long, and one that does not start on a slice boundary
    # can touch one slice more.
    while 2 * window_ms // width + 1 > FAN_IN:
        width *= FAN_IN
        df = df.withColumn("slice", _slice_start("first_ts", width))
        df = _join_slices(df, [*_USER_BUCKET, "slice"], gap_ms)
    users = _join_slices(df, _USER_BUCKET, gap_ms)
    counted = users.groupBy(*_CHANNEL_BUCKET).agg(
        F.sum(F.col("breaks") + 1).alias("count")
    )
    return release_bucket(counted)


def session_count_of(slices: DataFrame, window_ms: int, gap_ms: int) -> DataFrame:
    """Sessions from merged slices."""
    return _sessions_of_slices(
        slices.withColumnRenamed("timeMark", "bucket"), window_ms, gap_ms
    )


def session_count(
    messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS, gap_ms: int | None = None
) -> DataFrame:
    """Sessions per project, channel and window; the gap defaults to the window.

    A gap as long as the window can break only the one around 1970.
    """
    gap = window_ms if gap_ms is None else gap_ms
    if gap >= window_ms:
        return long_gap_sessions_of(_by_user(messages, window_ms, AROUND_1970), gap)
    return _sessions_of_slices(_slices(messages, window_ms, gap), window_ms, gap)
