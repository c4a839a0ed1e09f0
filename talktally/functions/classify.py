"""What a message status says about the conversation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from talktally import schema as s
from talktally.functions.presence import _col, present


def response_type(status: Column | str = "status") -> Column:
    """Kind of bot response; unknown and null statuses are the fallback."""
    kinds: dict[str, list[str]] = {}
    for name, kind in s.RESPONSE_TYPE_OF_STATUS.items():
        kinds.setdefault(kind, []).append(name)
    first, *rest = kinds.items()
    chain = reduce(
        lambda c, kv: c.when(_col(status).isin(kv[1]), F.lit(kv[0])),
        rest,
        F.when(_col(status).isin(first[1]), F.lit(first[0])),
    )
    return chain.otherwise(F.lit(s.FALLBACK_RESPONSE_TYPE))


def node_state(status: Column | str = "status") -> Column:
    return F.when(_col(status) == s.STATUS_INVALIDATED, F.lit(s.INVALID_NODE)).otherwise(
        F.lit(s.VALID_NODE)
    )


def is_journey_node() -> Column:
    """A message that moved within a flow, with every part of the move known."""
    return (
        F.col("status").isin(s.STATUS_VALIDATED, s.STATUS_INVALIDATED)
        & (F.col("prevConversationType") == s.FLOW_CONVERSATION)
        & present("intentName")
        & present("stageName")
        & present("previousStageName")
    )


def may_trigger() -> Column:
    """Statuses that can trigger an intent; a cheap test a scan can apply."""
    return F.col("status").isin(s.STATUS_GHOST, s.STATUS_START)


def trigger_intent(ghost_col: str = "stageName") -> Column:
    """Intent a message triggered, or empty text.

    `ghost_col` names the column a ghost trigger reports. "stageName" is what the
    original counts; "intentDetected" is what the metric's name suggests.
    """
    if ghost_col not in ("stageName", "intentDetected"):
        raise ValueError("ghost_col must be 'stageName' or 'intentDetected'")
    return (
        F.when((F.col("status") == s.STATUS_GHOST) & present(ghost_col), F.col(ghost_col))
        .when((F.col("status") == s.STATUS_START) & present("intentName"), F.col("intentName"))
        .otherwise(F.lit(""))
    )
