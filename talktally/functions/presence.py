"""One meaning of "missing": null, empty text, or the placeholder mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talktally.schema import MISSING_MARK


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def present(value: Column | str) -> Column:
    """True or false, never null, so it is safe under negation.

    Both halves can be pushed down to a columnar scan.
    """
    return _col(value).isNotNull() & ~_col(value).isin("", MISSING_MARK)


def only(messages: DataFrame, wanted: Column) -> DataFrame:
    """The messages that a metric is about.

    On a stream the condition reads the event time, so that Spark keeps it above the
    watermark: every message then moves the watermark, whichever metric reads it.
    """
    if messages.isStreaming:
        wanted = F.when(F.col("eventTime").isNotNull(), wanted)
    return messages.filter(wanted)


def missing_to_empty(value: Column | str) -> Column:
    """Null and empty text become the placeholder mark."""
    return F.coalesce(F.nullif(_col(value), F.lit("")), F.lit(MISSING_MARK))
