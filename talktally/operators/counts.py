"""Metrics that count messages by their own columns.

Each is one hash aggregation with partial counts before the shuffle, so a project
holding a third of all messages sends only its distinct keys from each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talktally.functions import node_state, only, present, response_type, trigger_intent
from talktally.functions.classify import is_journey_node, may_trigger
from talktally.functions.timing import release_bucket, with_bucket
from talktally.schema import (
    CHANNEL_KEYS,
    CHANNEL_WINDOW,
    DEFAULT_WINDOW_MS,
    INTENT_TRIGGER,
    JOURNEY_NODES,
    RESPONSE_TYPE,
)

_CHANNEL_BUCKET = [*CHANNEL_KEYS, "bucket"]

# Columns each counted metric adds to the channel window.
COUNT_ATTRIBUTES = {
    RESPONSE_TYPE: ["responseType"],
    JOURNEY_NODES: ["state", "intentName", "previousStageName", "stageName"],
    INTENT_TRIGGER: ["intentName"],
}
_LONG_FORM = ["responseType", "state", "intentName", "previousStageName", "stageName"]


def _count(messages: DataFrame, window_ms: int, *attributes: str) -> DataFrame:
    keys = [*_CHANNEL_BUCKET, *attributes]
    counted = with_bucket(messages, window_ms).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count")
    )
    return release_bucket(counted)


def message_count(messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Messages per project, channel and window."""
    return _count(messages, window_ms)


def resp_type(messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Messages per response type."""
    return _count(
        messages.withColumn("responseType", response_type("status")), window_ms, "responseType"
    )


def journey_nodes(messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Moves between stages of a flow, by whether the answer was valid."""
    moves = only(messages, is_journey_node()).withColumn("state", node_state("status"))
    return _count(moves, window_ms, *COUNT_ATTRIBUTES[JOURNEY_NODES])


def intent_triggers(
    messages: DataFrame, window_ms: int = DEFAULT_WINDOW_MS, ghost_col: str = "stageName"
) -> DataFrame:
    """How often each intent was triggered; see `trigger_intent` for `ghost_col`."""
    triggered = (
        only(messages, may_trigger() & present(trigger_intent(ghost_col)))
        .withColumn("intentName", trigger_intent(ghost_col))
    )
    return _count(triggered, window_ms, "intentName")


def message_counts(
    messages: DataFrame,
    window_ms: int = DEFAULT_WINDOW_MS,
    ghost_col: str = "stageName",
    split_by: Sequence[str] = (),
) -> DataFrame:
    """All counted metrics in long form, from one scan and one shuffle.

    Each message becomes one to three entries (metric plus that metric's columns)
    that are counted together. Message count is the sum of response types, so it
    needs no entry of its own.
    """

    def entry(metric: str, **values: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            *[
                values.get(c, F.lit(None)).cast("string").alias(c)
                for c in _LONG_FORM
            ],
        )

    trigger = trigger_intent(ghost_col)
    entries = F.array(
        entry(RESPONSE_TYPE, responseType=response_type("status")),
        F.when(
            is_journey_node(),
            entry(
                JOURNEY_NODES,
                state=node_state("status"),
                intentName=F.col("intentName"),
                previousStageName=F.col("previousStageName"),
                stageName=F.col("stageName"),
            ),
        ),
        F.when(may_trigger() & present(trigger), entry(INTENT_TRIGGER, intentName=trigger)),
    )
    where = [*_CHANNEL_BUCKET, *split_by]
    long_form = (
        with_bucket(messages, window_ms)
        .select(*where, F.explode(entries).alias("entry"))
        .filter(F.col("entry").isNotNull())
        .select(*where, "entry.*")
    )
    counted = long_form.groupBy(*where, "metric", *_LONG_FORM).agg(
        F.count(F.lit(1)).alias("count")
    )
    return release_bucket(counted)


def merge_counts(partials: DataFrame) -> DataFrame:
    """Counts are additive: partial results of any split sum to the whole."""
    keys = [*CHANNEL_WINDOW, "metric", *_LONG_FORM]
    return partials.groupBy(*keys).agg(F.sum("count").alias("count"))


def message_count_of(counts: DataFrame) -> DataFrame:
    return (
        counts.filter(F.col("metric") == RESPONSE_TYPE)
        .groupBy(*CHANNEL_WINDOW)
        .agg(F.sum("count").alias("count"))
    )


def counted_metric_of(counts: DataFrame, metric: str) -> DataFrame:
    """One metric out of the long form."""
    return counts.filter(F.col("metric") == metric).select(
        *CHANNEL_WINDOW, *COUNT_ATTRIBUTES[metric], "count"
    )
