"""Append typed rows to a document store through its Spark connector."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_store(
    table: DataFrame, collection: str, source: str = "mongodb", **options: str
) -> None:
    """Append each row as one document of `collection`.

    The connector, its address and its credentials are the caller's to supply. The
    same call writes "parquet" or "json" if `options` hold a `path`.
    """
    writer = table.write.format(source).mode("append")
    path = options.pop("path", None)
    if path is not None:
        writer.options(**options).save(f"{path}/{collection}")
    else:
        writer.option("collection", collection).options(**options).save()
