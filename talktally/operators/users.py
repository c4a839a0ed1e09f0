"""One row for each user in each window, and the metrics that follow from it.

Six metrics ask about a user's window: who was there, for how long, the first and
the last event, the last intent and the last stage. `user_windows` answers all of
them in one aggregation. Unused answers are pruned by Catalyst, so a single metric
pays only for its own columns, and a stored table of user windows serves them all.

Every column merges by count-sum, min or max. That makes merging associative and
commutative: partial results of any split of the messages give the whole result,
and partial aggregation before the shuffle keeps a user with a third of all
messages down to one row for each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talktally.functions import only, present
from talktally.functions.timing import release_bucket, with_bucket
from talktally.schema import CHANNEL_KEYS, DEFAULT_WINDOW_MS, EVENT_FIELDS

_USER_BUCKET = [*CHANNEL_KEYS, "bucket", "senderId"]
_CHANNEL_BUCKET = [*CHANNEL_KEYS, "bucket"]

# The two stamps next to 1970 tell whether a session ends there: that window is two long.
AROUND_1970 = ["last_before_1970", "first_since_1970"]
NUMBERS = ["messages", "min_ts", "max_ts", *AROUND_1970]
EVENTS = ["first_event", "last_event", "last_intent", "last_stage"]
STATES = [*NUMBERS, *EVENTS]


def _states() -> dict[str, Column]:
    # The struct orders by timestamp, then seq, then content, so the winner is the
    # same for any order of rows.
    event = F.struct("timestamp", "seq", *EVENT_FIELDS)
    intent = F.struct("timestamp", "seq", "intentName")
    stage = F.struct("timestamp", "seq", "intentName", "stageName")
    known = present("intentName")
    return {
        "messages": F.count(F.lit(1)),
        "min_ts": F.min("timestamp"),
        "max_ts": F.max("timestamp"),
        "last_before_1970": F.max(F.when(F.col("timestamp") < 0, F.col("timestamp"))),
        "first_since_1970": F.min(F.when(F.col("timestamp") >= 0, F.col("timestamp"))),
        "first_event": F.min(event),
        "last_event": F.max(event),
        "last_intent": F.max(F.when(known, intent)),
        "last_stage": F.max(F.when(known & F.col("stageName").isNotNull(), stage)),
    }


def _merges() -> dict[str, Column]:
    merge = {name: F.max(name) for name in STATES}
    merge["messages"] = F.sum("messages")
    merge["min_ts"] = F.min("min_ts")
    merge["first_since_1970"] = F.min("first_since_1970")
    merge["first_event"] = F.min("first_event")
    return merge


def _group(
    df: DataFrame, aggregates: dict[str, Column], states: Sequence[str], extra: Sequence[str]
) -> DataFrame:
    keys = [*_USER_BUCKET, *extra]
    chosen = [aggregates[name].alias(name) for name in states]
    if df.isStreaming or not set(states) & set(EVENTS):
        return df.groupBy(*keys).agg(*chosen)
    # Struct states make Spark sort by the group columns. A leading hash lets
    # that sort decide nearly every comparison on one number.
    lead = F.xxhash64(*keys).alias("key_hash")
    return df.groupBy(lead, *keys).agg(*chosen).drop("key_hash")


def _by_user(
    messages: DataFrame, window_ms: int, states: Sequence[str], extra: Sequence[str] = ()
) -> DataFrame:
    return _group(with_bucket(messages, window_ms), _states(), states, extra)


def user_windows(
    messages: DataFrame,
    window_ms: int = DEFAULT_WINDOW_MS,
    states: Sequence[str] = STATES,
    split_by: Sequence[str] = (),
) -> DataFrame:
    """The mergeable state of each user's window.

    `split_by` adds columns that keep partial results apart, such as a batch id.
    """
    return release_bucket(_by_user(messages, window_ms, states, split_by))


def merge_user_windows(partials: DataFrame, states: Sequence[str] = STATES) -> DataFrame:
    """Combine partial user windows into one row for each user's window."""
    keyed = partials.withColumnRenamed("timeMark", "bucket")
    return release_bucket(_group(keyed, _merges(), states, ()))


# Metrics of a table of user windows. `users` has a `bucket` or a `timeMark`.


def _keys(users: DataFrame, names: Sequence[str]) -> list[str]:
    mark = "bucket" if "bucket" in users.columns else "timeMark"
    return [mark if name == "bucket" else name for name in names]


def _finish(df: DataFrame) -> DataFrame:
    return release_bucket(df) if "bucket" in df.columns else df


def distinct_users_of(users: DataFrame) -> DataFrame:
    return _finish(users.select(*_keys(users, _USER_BUCKET)))


def message_count_of(users: DataFrame) -> DataFrame:
    return _finish(
        users.groupBy(*_keys(users, _CHANNEL_BUCKET)).agg(F.sum("messages").alias("count"))
    )


def time_spent_of(users: DataFrame, max_span_ms: int) -> DataFrame:
    spent = users.withColumn("span", F.col("max_ts") - F.col("min_ts"))
    return _finish(
        spent.filter(F.col("span") <= max_span_ms)
        .groupBy(*_keys(users, _CHANNEL_BUCKET))
        .agg(F.sum("span").alias("totalTime"))
    )


def long_gap_sessions_of(users: DataFrame, gap_ms: int) -> DataFrame:
    """Sessions for a gap no shorter than the window: users, and breaks around 1970.

    Time marks truncate toward zero, so the window around 1970 is twice as long as the
    others; nowhere else can two messages of a window be further apart than the gap.
    """
    silence = F.col("first_since_1970") - F.col("last_before_1970")
    sessions = F.when(silence > gap_ms, 2).otherwise(1)
    return _finish(
        users.groupBy(*_keys(users, _CHANNEL_BUCKET)).agg(F.sum(sessions).alias("count"))
    )


def _last_of(users: DataFrame, state: str, fields: Sequence[str]) -> DataFrame:
    named = users.filter(F.col(state).isNotNull()).select(
        *_keys(users, _CHANNEL_BUCKET), *[F.col(f"{state}.{f}").alias(f) for f in fields]
    )
    return _finish(
        named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("count"))
    )


def drop_off_intent_of(users: DataFrame) -> DataFrame:
    return _last_of(users, "last_intent", ["intentName"])


def drop_off_stage_of(users: DataFrame) -> DataFrame:
    return _last_of(users, "last_stage", ["intentName", "stageName"])


def _open_sessions(users: DataFrame, event: str, stamp: str, max_age_ms: int) -> DataFrame:
    flat = _finish(
        users.select(
            *_keys(users, _USER_BUCKET),
            *[
                F.col(f"{event}.{f}").alias("previousStage" if f == "previousStageName" else f)
                for f in EVENT_FIELDS
            ],
            F.col(f"{event}.timestamp").alias(stamp),
        )
    )
    return flat.filter(F.col("timeMark") - F.col(stamp) <= max_age_ms)


def open_sessions_last_of(users: DataFrame, max_age_ms: int) -> DataFrame:
    return _open_sessions(users, "last_event", "maxTimestamp", max_age_ms)


def open_sessions_first_of(users: DataFrame, max_age_ms: int) -> DataFrame:
    return _open_sessions(users, "first_event", "minTimestamp", max_age_ms)


# The same metrics straight from messages.


def distinct_users(messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Each user once for each window. A null sender counts as one user."""
    return distinct_users_of(_by_user(messages, window_ms, ["messages"]))


def time_spent(
    messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS, max_span_ms: int | None = None
) -> DataFrame:
    """Time from each user's first to last message, summed over users."""
    users = _by_user(messages, window_ms, ["min_ts", "max_ts"])
    return time_spent_of(users, window_ms if max_span_ms is None else max_span_ms)


def drop_off_intent(messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Users by the intent of their last message that had one."""
    known = only(messages, present("intentName"))
    return drop_off_intent_of(_by_user(known, window_ms, ["last_intent"]))


def drop_off_stage(messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Users by intent and stage of their last message that had both."""
    known = only(messages, present("intentName") & F.col("stageName").isNotNull())
    return drop_off_stage_of(_by_user(known, window_ms, ["last_stage"]))


def open_sessions_last(
    messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS, max_age_ms: int | None = None
) -> DataFrame:
    """The last event of each user's window."""
    users = _by_user(messages, window_ms, ["last_event"])
    return open_sessions_last_of(users, window_ms if max_age_ms is None else max_age_ms)


def open_sessions_first(
    messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS, max_age_ms: int | None = None
) -> DataFrame:
    """The first event of each user's window."""
    users = _by_user(messages, window_ms, ["first_event"])
    return open_sessions_first_of(users, window_ms if max_age_ms is None else max_age_ms)
