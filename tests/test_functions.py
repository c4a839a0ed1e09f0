"""Column expressions, one test for each trap."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from talktally import functions as fn
from talktally.functions.timing import wall_clock_ms

W = 300_000


def values(df, name="x"):
    return [r[name] for r in df.select(name).collect()]


def test_present_is_never_null(spark):
    df = spark.createDataFrame([(None,), ("",), ("EMPTY",), ("a",), ("empty",)], "v string")
    assert values(df.select(fn.present("v").alias("x"))) == [False, False, False, True, True]
    assert values(df.select((~fn.present("v")).alias("x"))) == [True, True, True, False, False]


def test_missing_to_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("EMPTY",), ("a",)], "v string")
    assert values(df.select(fn.missing_to_empty("v").alias("x"))) == ["EMPTY"] * 3 + ["a"]


def test_time_mark_is_the_exclusive_window_end(spark):
    df = spark.createDataFrame([(0,), (W - 1,), (W,), (2 * W - 1,), (2 * W,)], "v bigint")
    assert values(df.select(fn.time_mark("v", W).alias("x"))) == [W, W, 2 * W, 2 * W, 3 * W]


def test_time_mark_truncates_toward_zero_before_1970(spark):
    df = spark.createDataFrame([(-1,), (-W,), (-W - 1,)], "v bigint")
    assert values(df.select(fn.time_mark("v", W).alias("x"))) == [W, 0, 0]


def test_time_mark_equals_the_event_time_window(spark):
    df = spark.createDataFrame([(1_704_067_200_000,), (1_704_067_499_999,)], "v bigint")
    both = df.select(
        fn.time_mark("v", W).alias("mark"),
        F.unix_millis(F.window(fn.event_time("v"), "5 minutes")["end"]).alias("end"),
    )
    assert all(r["mark"] == r["end"] for r in both.collect())


def test_window_must_be_positive():
    with pytest.raises(ValueError):
        fn.time_mark(F.lit(1), 0)


def test_to_long_gives_null_for_text_that_is_no_number(spark):
    df = spark.createDataFrame([("12",), ("-3",), ("x",), ("",), ("1.7E12",), (None,)], "v string")
    assert values(df.select(fn.to_long("v").alias("x"))) == [12, -3, None, None, None, None]


@pytest.mark.parametrize(
    ("ms", "zone", "text"),
    [
        (1_704_067_200_000, "Asia/Calcutta", "2024-01-01T05:30+05:30[Asia/Calcutta]"),
        (1_704_067_201_000, "Asia/Calcutta", "2024-01-01T05:30:01+05:30[Asia/Calcutta]"),
        (1_704_067_201_050, "Asia/Calcutta", "2024-01-01T05:30:01.050+05:30[Asia/Calcutta]"),
        (-1, "America/New_York", "1969-12-31T18:59:59.999-05:00[America/New_York]"),
        (0, "UTC", "1970-01-01T00:00Z[UTC]"),
        # Skipped by daylight saving in the session's zone, which must not matter.
        (1_710_037_800_000, "UTC", "2024-03-10T02:30Z[UTC]"),
    ],
)
def test_zoned_text(spark, ms, zone, text):
    df = spark.createDataFrame([(ms,)], "v bigint")
    assert values(df.select(fn.zoned_text("v", zone).alias("x"))) == [text]


def test_wall_clock_does_not_use_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS v")
    assert values(df.select(wall_clock_ms("v").alias("x"))) == [1_710_037_800_123]


def test_response_types(spark):
    expected = {
        "cancel": "CANCELLED",
        "nextStart": "INTENT-TRIGGERED",
        "inFlowNextValidated": "JOURNEY-VALID",
        "inFlowPrevious": "JOURNEY-VALID",
        "inFlowNextInvalidated": "JOURNEY-INVALID",
        "inFlowNextGhost": "JOURNEY-GHOST",
        "cancelStuck": "JOURNEY-STUCK",
        "nextOptions": "OPTIONS",
        "other": "FALLBACK",
        "": "FALLBACK",
        None: "FALLBACK",
    }
    df = spark.createDataFrame([(s,) for s in expected], "status string")
    assert values(df.select(fn.response_type().alias("x"))) == list(expected.values())


def test_trigger_reads_the_chosen_ghost_column(spark):
    rows = [
        ("inFlowNextGhost", "stage", "intent", "detected"),
        ("inFlowNextGhost", "EMPTY", "intent", None),
        ("nextStart", "stage", "intent", "detected"),
        ("nextStart", "stage", "", "detected"),
        ("cancel", "stage", "intent", "detected"),
        (None, "stage", "intent", "detected"),
    ]
    df = spark.createDataFrame(
        rows, "status string, stageName string, intentName string, intentDetected string"
    )
    observed = values(df.select(fn.trigger_intent().alias("x")))
    assert observed == ["stage", "", "intent", "", "", ""]
    intended = values(df.select(fn.trigger_intent("intentDetected").alias("x")))
    assert intended == ["detected", "", "intent", "", "", ""]
    with pytest.raises(ValueError):
        fn.trigger_intent("senderId")


def test_documents_keep_nulls_and_escape_text(spark):
    df = spark.createDataFrame([('a"b\\c', None)], "p string, q string")
    assert values(df.select(fn.document("p", "q").alias("x"))) == ['{"p":"a\\"b\\\\c","q":null}']


def test_strip_backslashes(spark):
    df = spark.createDataFrame([("a\\b\\\\c",)], "v string")
    assert values(df.select(fn.strip_backslashes("v").alias("x"))) == ["abc"]


def test_collection_name():
    assert fn.collection_name("respType", W) == "respType_300"
    with pytest.raises(ValueError):
        fn.collection_name("respType", 1500)
