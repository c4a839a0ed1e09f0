"""The stored, mergeable state from which all metrics follow.

Three tables hold everything: message counts in long form, one row for each user's
window, and session slices when the session gap is shorter than the window. A
batch writes its own partial tables under `batch_id=N`. Writing a batch again
replaces it, so a retried batch changes nothing. Reading merges the partials.

Within a batch the tables are partitioned by the date of the window, so a report
on some days reads only those days.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from talktally.operators import counts, sessions, users
from talktally.operators.users import AROUND_1970, STATES
from talktally.plans.groups import GROUPS, check_groups
from talktally.schema import (
    DEFAULT_WINDOW_MS,
    INTENT_TRIGGER,
    JOURNEY_NODES,
    RESPONSE_TYPE,
)

# State columns each metric group needs of a user's window.
_GROUP_STATES = {
    "engagement": ["messages", "min_ts", "max_ts", *AROUND_1970],
    "performance": ["last_intent", "last_stage"],
    "detailed": ["first_event", "last_event"],
}


# 0001-01-01 and 9999-12-31 as days since 1970.
FIRST_DAY, LAST_DAY = -719_162, 2_932_896
FOLDER_FIELDS = [StructField("batch_id", LongType()), StructField("event_date", DateType())]


@dataclass(frozen=True)
class MetricState:
    """State tables and the settings they were made with."""

    counts: DataFrame
    users: DataFrame
    slices: DataFrame | None
    window_ms: int
    gap_ms: int

    def tables(self) -> dict[str, DataFrame]:
        found = {"counts": self.counts, "users": self.users}
        return found if self.slices is None else found | {"slices": self.slices}


def build_state(
    messages: DataFrame,
    groups: Iterable[str] = tuple(GROUPS),
    window_ms: int = DEFAULT_WINDOW_MS,
    gap_ms: int | None = None,
    ghost_col: str = "stageName",
    split_by: tuple[str, ...] = (),
) -> MetricState:
    """State of a table of messages; nothing runs until it is written or read.

    `split_by` keeps partial results apart by the columns it names.
    """
    chosen = check_groups(groups)
    gap = window_ms if gap_ms is None else gap_ms
    needed = {name for group in chosen for name in _GROUP_STATES[group]}
    states = [name for name in STATES if name in needed]
    sliced = "engagement" in chosen and gap < window_ms
    return MetricState(
        counts=counts.message_counts(messages, window_ms, ghost_col, split_by),
        users=users.user_windows(messages, window_ms, states, split_by),
        slices=sessions.session_slices(messages, window_ms, gap, split_by) if sliced else None,
        window_ms=window_ms,
        gap_ms=gap,
    )


def merge_state(state: MetricState) -> MetricState:
    """Combine partial rows; a no-op in meaning for state that is already whole."""
    return MetricState(
        counts=counts.merge_counts(state.counts),
        users=users.merge_user_windows(
            state.users, [name for name in STATES if name in state.users.columns]
        ),
        slices=None if state.slices is None else sessions.merge_session_slices(state.slices),
        window_ms=state.window_ms,
        gap_ms=state.gap_ms,
    )


def table_path(path: str, name: str, window_ms: int, gap_ms: int) -> str:
    # Partials of different windows or gaps must never be merged with each other.
    settings = f"window_ms={window_ms}"
    if name == "slices":
        settings += f"/gap_ms={gap_ms}"
    return f"{path}/{name}/{settings}"


def write_state(
    state: MetricState, path: str, batch_id: int = 0, gather_dates: bool = True
) -> None:
    """Write one batch's partial tables, replacing an earlier try of the same batch.

    `gather_dates` brings the rows of a date together before writing, so that a
    backfill of many dates does not leave a small file from every task in each. Spark
    splits the large dates again. A micro-batch spans few dates and can do without.
    """
    for name, table in state.tables().items():
        dated = table.withColumn("event_date", window_date("timeMark", state.window_ms))
        if gather_dates:
            dated = dated.hint("rebalance", F.col("event_date"))
        (
            dated.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("event_date")
            .parquet(
                f"{table_path(path, name, state.window_ms, state.gap_ms)}/batch_id={batch_id}"
            )
        )


def read_state(
    spark: SparkSession,
    path: str,
    window_ms: int = DEFAULT_WINDOW_MS,
    gap_ms: int | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    batch_id: int | None = None,
    groups: Iterable[str] = tuple(GROUPS),
    like: MetricState | None = None,
) -> MetricState:
    """State written under `path` for `groups`; dates bound the windows read.

    All batches are merged. One batch alone, named by `batch_id`, is whole as it was
    written and costs no shuffle. `like` gives the schemas, for a store that may not
    hold a single row yet. Windows before year 1 and after year 9999, which folder names
    cannot hold, are stored under the first and the last date, and dates bound them there.
    """
    gap = window_ms if gap_ms is None else gap_ms
    sliced = "engagement" in check_groups(groups) and gap < window_ms

    def table(name: str) -> DataFrame:
        reader = spark.read
        if like is not None:
            known = like.tables()[name].schema.fields
            reader = reader.schema(StructType([*known, *FOLDER_FIELDS]))
        df = reader.parquet(table_path(path, name, window_ms, gap))
        if from_date is not None:
            df = df.filter(F.col("event_date") >= F.lit(from_date).cast("date"))
        if to_date is not None:
            df = df.filter(F.col("event_date") <= F.lit(to_date).cast("date"))
        if batch_id is not None:
            df = df.filter(F.col("batch_id") == batch_id)
        return df.drop("event_date", "batch_id")

    state = MetricState(
        counts=table("counts"),
        users=table("users"),
        slices=table("slices") if sliced else None,
        window_ms=window_ms,
        gap_ms=gap,
    )
    return merge_state(state) if batch_id is None else state


def compact_state(
    spark: SparkSession,
    path: str,
    into: str,
    window_ms: int = DEFAULT_WINDOW_MS,
    gap_ms: int | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    groups: Iterable[str] = tuple(GROUPS),
) -> MetricState:
    """Merge all batches once, store the result under `into`, and return it from there.

    Metrics of compacted state share that one merge instead of each doing its own.
    """
    chosen = check_groups(groups)
    merged = read_state(
        spark, path, window_ms, gap_ms, from_date, to_date, groups=chosen
    )
    write_state(merged, into)
    return read_state(
        spark, into, window_ms, gap_ms, batch_id=0, groups=chosen, like=merged
    )


def metrics_of(
    state: MetricState,
    groups: Iterable[str] = tuple(GROUPS),
    max_span_ms: int | None = None,
    max_age_ms: int | None = None,
) -> dict[str, DataFrame]:
    """Metric tables of whole (merged) state, by query name."""
    span = state.window_ms if max_span_ms is None else max_span_ms
    age = state.window_ms if max_age_ms is None else max_age_ms
    tables: dict[str, DataFrame] = {}
    for group in check_groups(groups):
        if group == "engagement":
            tables["message_count"] = counts.message_count_of(state.counts)
            tables["distinct_users"] = users.distinct_users_of(state.users)
            tables["time_spent"] = users.time_spent_of(state.users, span)
            tables["session_count"] = (
                users.long_gap_sessions_of(state.users, state.gap_ms)
                if state.slices is None
                else sessions.session_count_of(state.slices, state.window_ms, state.gap_ms)
            )
        elif group == "performance":
            tables["resp_type"] = counts.counted_metric_of(state.counts, RESPONSE_TYPE)
            tables["drop_off_intent"] = users.drop_off_intent_of(state.users)
            tables["drop_off_stage"] = users.drop_off_stage_of(state.users)
        else:
            tables["journey_nodes"] = counts.counted_metric_of(state.counts, JOURNEY_NODES)
            tables["intent_triggers"] = counts.counted_metric_of(state.counts, INTENT_TRIGGER)
            tables["open_sessions_last"] = users.open_sessions_last_of(state.users, age)
            tables["open_sessions_first"] = users.open_sessions_first_of(state.users, age)
    return tables


def window_date(mark: str, window_ms: int) -> Column:
    """UTC date on which the window starts, whatever the session time zone.

    Folder names hold years 1 to 9999; anything beyond goes to the last or first date.
    """
    days = F.floor((F.col(mark) - window_ms) / F.lit(86_400_000))
    named = F.greatest(F.least(days, F.lit(LAST_DAY)), F.lit(FIRST_DAY))
    return F.date_add(F.lit("1970-01-01").cast("date"), named.cast("int"))
