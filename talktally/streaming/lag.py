"""How far behind a batch is: the period it covers and the delay of its data."""

from __future__ import annotations

import json
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from talktally.functions import zoned_text

log = logging.getLogger(__name__)


def batch_lag(
    messages: DataFrame,
    batch_time: Column,
    interval_ms: int,
    zone: str = "Asia/Calcutta",
) -> DataFrame:
    """One row for each batch time (epoch ms) in `messages`.

    Covers the period up to the batch time, as text in `zone`, the number of
    messages, their first and last timestamp, and the delay in whole seconds from
    the last message to the batch time.
    """
    by_batch = (
        messages.withColumn("batch_time", batch_time.cast("bigint"))
        .groupBy("batch_time")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("timestamp").alias("min_ts"),
            F.max("timestamp").alias("max_ts"),
        )
    )
    return by_batch.select(
        "batch_time",
        zoned_text(F.col("batch_time") - interval_ms, zone).alias("from_time"),
        zoned_text("batch_time", zone).alias("to_time"),
        "messages",
        "min_ts",
        "max_ts",
        F.call_function(
            "div", F.col("batch_time") - F.col("max_ts"), F.lit(1000)
        ).alias("delay_s"),
    )


class LagListener(StreamingQueryListener):
    """Logs rows, durations and event-time range of every micro-batch."""

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        log.info(
            "query %s batch %s: %s rows, event time %s, took %s",
            p.id,
            p.batchId,
            p.numInputRows,
            json.dumps(dict(p.eventTime)),
            json.dumps(dict(p.durationMs)),
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("query %s ended: %s", event.id, event.exception or "no error")
