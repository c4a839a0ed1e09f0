"""JSON documents and the names of the collections they go to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talktally.functions.presence import _col


def document(*columns: Column | str) -> Column:
    """One JSON object. Nulls stay nulls and text is escaped."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def strip_backslashes(value: Column | str) -> Column:
    """Remove every backslash, as the original does before sending to Kafka."""
    return F.replace(_col(value), F.lit("\\"), F.lit(""))


def collection_name(tag: str, window_ms: int) -> str:
    """Collection and topic of a metric, e.g. respType_300."""
    if window_ms % 1000:
        raise ValueError("a collection name holds whole seconds")
    return f"{tag}_{window_ms // 1000}"
