"""The metric groups: engagement, performance, detailed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from talktally import operators as op
from talktally.schema import DEFAULT_WINDOW_MS

# Query name of each metric, by group.
GROUPS = {
    "engagement": ["message_count", "distinct_users", "time_spent", "session_count"],
    "performance": ["resp_type", "drop_off_intent", "drop_off_stage"],
    "detailed": [
        "journey_nodes",
        "intent_triggers",
        "open_sessions_last",
        "open_sessions_first",
    ],
}


def engagement(
    messages: DataFrame,
    window_ms: int = DEFAULT_WINDOW_MS,
    gap_ms: int | None = None,
    max_span_ms: int | None = None,
) -> dict[str, DataFrame]:
    return {
        "message_count": op.message_count(messages, window_ms),
        "distinct_users": op.distinct_users(messages, window_ms),
        "time_spent": op.time_spent(messages, window_ms, max_span_ms),
        "session_count": op.session_count(messages, window_ms, gap_ms),
    }


def performance(
    messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS
) -> dict[str, DataFrame]:
    return {
        "resp_type": op.resp_type(messages, window_ms),
        "drop_off_intent": op.drop_off_intent(messages, window_ms),
        "drop_off_stage": op.drop_off_stage(messages, window_ms),
    }


def detailed(
    messages: DataFrame,
    window_ms: int = DEFAULT_WINDOW_MS,
    ghost_col: str = "stageName",
    max_age_ms: int | None = None,
) -> dict[str, DataFrame]:
    return {
        "journey_nodes": op.journey_nodes(messages, window_ms),
        "intent_triggers": op.intent_triggers(messages, window_ms, ghost_col),
        "open_sessions_last": op.open_sessions_last(messages, window_ms, max_age_ms),
        "open_sessions_first": op.open_sessions_first(messages, window_ms, max_age_ms),
    }


def check_groups(groups: Iterable[str]) -> list[str]:
    names = list(groups)
    unknown = [g for g in names if g not in GROUPS]
    if unknown:
        raise ValueError(f"unknown metric groups {unknown}; choose from {list(GROUPS)}")
    return names


def metric_groups(
    messages: DataFrame,
    groups: Iterable[str] = tuple(GROUPS),
    window_ms: int = DEFAULT_WINDOW_MS,
    gap_ms: int | None = None,
    ghost_col: str = "stageName",
    max_span_ms: int | None = None,
    max_age_ms: int | None = None,
) -> dict[str, DataFrame]:
    """The chosen groups' metrics, each its own lazy query over `messages`.

    For all of them at scale, store the shared state instead; see `state`.
    """
    tables: dict[str, DataFrame] = {}
    for group in check_groups(groups):
        if group == "engagement":
            tables |= engagement(messages, window_ms, gap_ms, max_span_ms)
        elif group == "performance":
            tables |= performance(messages, window_ms)
        else:
            tables |= detailed(messages, window_ms, ghost_col, max_age_ms)
    return tables
