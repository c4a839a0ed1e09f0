"""Stored user sketches, from which the users of any longer period follow.

Each batch writes the sketches of its windows under its own id, by date, as the state is
stored; a retried batch replaces its first try. Reading merges what batches have of one
window, so late messages only add to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talktally.operators.reach import merge_user_sketches
from talktally.plans.state import window_date


def _path(path: str, window_ms: int) -> str:
    # Sketches of different windows must never be merged with each other.
    return f"{path}/window_ms={window_ms}"


def write_user_sketches(
    sketches: DataFrame, path: str, window_ms: int, batch_id: int = 0
) -> None:
    """Write the sketches of one batch, all windows of a date together."""
    (
        sketches.withColumn("event_date", window_date("timeMark", window_ms))
        .hint("rebalance", F.col("event_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("event_date")
        .parquet(f"{_path(path, window_ms)}/batch_id={batch_id}")
    )


def read_user_sketches(
    spark: SparkSession,
    path: str,
    window_ms: int,
    from_date: str | None = None,
    to_date: str | None = None,
) -> DataFrame:
    """Sketches of all batches, merged; only the folders of the dates asked for are read."""
    schema = (
        "projectId string, channel string, timeMark bigint, sketch binary, "
        "batch_id bigint, event_date date"
    )
    rows = spark.read.schema(schema).parquet(_path(path, window_ms))
    if from_date is not None:
        rows = rows.filter(F.col("event_date") >= F.lit(from_date).cast("date"))
    if to_date is not None:
        rows = rows.filter(F.col("event_date") <= F.lit(to_date).cast("date"))
    return merge_user_sketches(rows.drop("event_date", "batch_id"))
