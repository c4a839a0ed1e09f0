"""The driver's `events` table read as chatbot messages.

Every rule is arithmetic on the row itself, so the same text in plain SQL gives
the same messages, and all kinds of missing value occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from talktally.functions import document, event_time
from talktally.functions.timing import wall_clock_ms
from talktally.sources.parsing import MESSAGE_COLUMNS, bot_messages

FIELD_RULES = {
    "projectId": (
        "CASE event_id % 23 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'EMPTY' "
        "ELSE concat('p', CAST(user_id % 4 AS STRING)) END"
    ),
    "channel": (
        "CASE user_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' "
        "ELSE concat('ch', CAST(user_id % 3 AS STRING)) END"
    ),
    "senderId": (
        "CASE WHEN event_id % 29 = 0 THEN NULL ELSE concat('u', CAST(user_id AS STRING)) END"
    ),
    "status": (
        "CASE event_id % 11 WHEN 0 THEN 'nextStart' WHEN 1 THEN 'inFlowNextValidated' "
        "WHEN 2 THEN 'inFlowNextInvalidated' WHEN 3 THEN 'inFlowNextGhost' "
        "WHEN 4 THEN 'inFlowPrevious' WHEN 5 THEN 'cancel' WHEN 6 THEN 'cancelStuck' "
        "WHEN 7 THEN 'nextOptions' WHEN 8 THEN 'somethingElse' WHEN 9 THEN NULL "
        "ELSE 'inFlowNextValidated' END"
    ),
    "prevConversationType": (
        "CASE event_type WHEN 'signup' THEN 'faq' WHEN 'error' THEN 'EMPTY' ELSE 'flow' END"
    ),
    "previousStageName": (
        "CASE WHEN event_id % 13 = 0 THEN '' ELSE concat('s', CAST(k % 3 AS STRING)) END"
    ),
    "intentName": (
        "CASE k % 13 WHEN 0 THEN NULL WHEN 1 THEN 'EMPTY' WHEN 2 THEN '' "
        "ELSE concat('i', CAST(k % 6 AS STRING)) END"
    ),
    "intentDetected": (
        "CASE WHEN k % 5 = 0 THEN NULL ELSE concat('d', CAST(k % 4 AS STRING)) END"
    ),
    "stageName": (
        "CASE event_id % 17 WHEN 0 THEN NULL WHEN 1 THEN '' "
        "ELSE concat('s', CAST(k % 5 AS STRING)) END"
    ),
    "humanSupport": (
        "CASE event_id % 19 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN NULL "
        "WHEN 3 THEN 'EMPTY' ELSE '' END"
    ),
}


def _events_with_fields(events: DataFrame) -> DataFrame:
    if isinstance(events.schema["ts"].dataType, TimestampNTZType):
        epoch = wall_clock_ms("ts")
    else:
        epoch = F.unix_millis("ts")
    keyed = events.withColumn("k", F.expr("CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"))
    return keyed.select(
        F.col("event_id").alias("seq"),
        *[F.expr(rule).alias(name) for name, rule in FIELD_RULES.items()],
        epoch.alias("timestamp"),
    )


def events_as_messages(events: DataFrame) -> DataFrame:
    """`events` rows to messages, after the bot-message filter."""
    return (
        bot_messages(_events_with_fields(events))
        .withColumn("eventTime", event_time("timestamp"))
        .select(*MESSAGE_COLUMNS)
    )


def events_as_raw(events: DataFrame) -> DataFrame:
    """`events` rows to raw lines (value, seq), some of them faulty.

    By event_id: one in 31 is empty, one in 37 is cut off, one in 41 comes inside
    an array, one in 43 has an unreadable timestamp, one in 47 has no payload.
    """
    fields = _events_with_fields(events)
    status = F.struct(
        F.col("status").alias("final"),
        F.col("prevConversationType").alias("prevConversation"),
        F.col("previousStageName").alias("previousStage"),
    )
    fault = F.when(F.col("seq") % 43 == 0, F.lit("t")).otherwise(F.lit(""))
    line = document(
        "projectId",
        F.col("channel").alias("filterCode"),
        "senderId",
        F.when(F.col("seq") % 47 != 0, F.struct(status.alias("status"))).alias("payload"),
        F.col("intentName").alias("conversationId"),
        F.col("intentDetected").alias("intentName"),
        "stageName",
        F.concat(fault, F.col("timestamp").cast("string")).alias("timestamp"),
        F.col("humanSupport").alias("requestAssistance"),
    )
    in_array = (F.col("seq") % 41 == 0) & (F.col("seq") % 37 != 0) & (F.col("seq") % 31 != 0)
    text = (
        F.when(F.col("seq") % 31 == 0, F.lit(""))
        .when(F.col("seq") % 37 == 0, F.substring(line, 1, 20))
        .otherwise(line)
    )
    value = F.concat(
        F.when(in_array, F.lit("[")).otherwise(F.lit("")),
        text,
        F.when(in_array, F.lit("]")).otherwise(F.lit("")),
    )
    # Exploding one value looks idle, but without it Catalyst pushes every filter on
    # the text below the projection that builds it, and builds each line twice.
    return fields.select(F.explode(F.array(value)).alias("value"), "seq")
