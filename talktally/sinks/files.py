"""Files written once for each batch: writing a batch again replaces it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_batch_parquet(table: DataFrame, path: str, batch_id: int) -> None:
    table.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_batch_text(documents: DataFrame, path: str, batch_id: int) -> None:
    """Documents as text, in one directory for each collection."""
    (
        documents.select("collection", "value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("collection")
        .text(f"{path}/batch_id={batch_id}")
    )
