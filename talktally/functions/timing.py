"""Event time: epoch milliseconds, tumbling windows, zoned text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talktally.functions.presence import _col
from talktally.schema import DEFAULT_WINDOW_MS


# Largest epoch ms, rounded, whose microseconds still fit a TIMESTAMP.
MAX_CLOCK_MS = 9_000_000_000_000_000


def to_long(value: Column | str) -> Column:
    """Text to BIGINT; null where it is not a whole number."""
    return _col(value).try_cast("bigint")


def time_mark(timestamp: Column | str, window_ms: int = DEFAULT_WINDOW_MS) -> Column:
    """Exclusive end of the tumbling window holding `timestamp`, in epoch ms.

    Integer division truncates toward zero, so a timestamp before 1970 goes to
    the window a truncating division gives it.
    """
    _check_window(window_ms)
    width = F.lit(window_ms).cast("bigint")
    return (F.call_function("div", _col(timestamp), width) + F.lit(1).cast("bigint")) * width


def event_time(timestamp: Column | str) -> Column:
    """Epoch ms as TIMESTAMP, the type watermarks need; null beyond its range."""
    ms = _col(timestamp)
    return F.when(ms.between(-MAX_CLOCK_MS, MAX_CLOCK_MS), F.timestamp_millis(ms))


def wall_clock_ms(clock: Column | str) -> Column:
    """TIMESTAMP_NTZ as epoch ms of the same wall clock in UTC.

    Built from calendar fields: timestampdiff would go through the session time zone
    and move clocks that its daylight saving skips.
    """
    c = _col(clock)
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    part = (F.extract(F.lit("SECOND"), c) * 1000).cast("bigint")
    return (F.unix_date(c.cast("date")).cast("bigint") * 86400 + seconds) * 1000 + part


def zoned_text(epoch_ms: Column | str, zone: str = "Asia/Calcutta") -> Column:
    """Epoch ms as ISO text with offset and zone, e.g. 2024-01-01T05:30+05:30[Asia/Calcutta].

    Seconds and milliseconds appear only when they are not zero. The result does
    not depend on the session time zone. Beyond the range of a TIMESTAMP it is null.
    """
    ms = _col(epoch_ms)
    ms = F.when(ms.between(-MAX_CLOCK_MS, MAX_CLOCK_MS), ms)
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    day_ms = F.lit(86_400_000)
    utc = epoch + F.make_dt_interval(
        days=F.floor(ms / day_ms).cast("int"),
        secs=(F.pmod(ms, day_ms) / F.lit(1000)).cast("decimal(18,6)"),
    )
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    offset = wall_clock_ms(local) - wall_clock_ms(utc)
    minutes = F.call_function("div", F.abs(offset), F.lit(60_000))
    # Formatting would go through the session time zone; a cast to text does not.
    text = local.cast("string")
    day = F.concat(F.substring(text, 1, 10), F.lit("T"))
    clock = (
        F.when(F.pmod(ms, F.lit(60_000)) == 0, F.concat(day, F.substring(text, 12, 5)))
        .when(F.pmod(ms, F.lit(1000)) == 0, F.concat(day, F.substring(text, 12, 8)))
        .otherwise(
            F.concat(
                day,
                F.substring(text, 12, 8),
                F.lit("."),
                F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"),
            )
        )
    )
    sign = F.when(offset < 0, F.lit("-")).otherwise(F.lit("+"))
    shift = F.when(offset == 0, F.lit("Z")).otherwise(
        F.format_string(
            "%s%02d:%02d",
            sign,
            F.call_function("div", minutes, F.lit(60)),
            F.pmod(minutes, F.lit(60)),
        )
    )
    return F.concat(clock, shift, F.lit(f"[{zone}]"))


def with_bucket(messages: DataFrame, window_ms: int) -> DataFrame:
    """Add `bucket`: the time mark for a table, the event-time window for a stream.

    A stream keeps the window struct until the last aggregation, because that is
    the column that carries the watermark.
    """
    _check_window(window_ms)
    if messages.isStreaming:
        return messages.withColumn(
            "bucket", F.window("eventTime", f"{window_ms} milliseconds")
        )
    return messages.withColumn("bucket", time_mark("timestamp", window_ms))


def release_bucket(df: DataFrame) -> DataFrame:
    """Turn `bucket` back into timeMark, in place."""
    mark = F.unix_millis("bucket.end") if df.isStreaming else F.col("bucket")
    return df.select(
        *[mark.alias("timeMark") if c == "bucket" else F.col(c) for c in df.columns]
    )


def _check_window(window_ms: int) -> None:
    if window_ms <= 0:
        raise ValueError(f"window_ms must be positive, got {window_ms}")
