"""Final mode: each key comes out once, when the watermark has passed its window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def final_metric(
    messages: DataFrame,
    metric: Callable[..., DataFrame],
    delay: str = "10 minutes",
    **options,
) -> DataFrame:
    """Any metric of `operators` over a stream of messages.

    Rows later than `delay` behind the newest event are left out by Spark's watermark;
    use partial mode where late rows must count.
    """
    if not messages.isStreaming:
        raise ValueError("final mode needs a stream; call the metric itself on a table")
    return metric(messages.withWatermark("eventTime", delay), **options)


def start_final(
    table: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "300 seconds",
) -> StreamingQuery:
    """Append final rows to parquet under `path`, exactly once."""
    writer = (
        table.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()
