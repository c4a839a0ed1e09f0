"""Raw JSON lines to canonical messages.

raw (value, seq) -> parse_events -> events (eleven text columns, seq, and what
was wrong) -> bot_messages -> usable | quarantined -> messages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talktally.functions import event_time, present, to_long
from talktally.schema import COLUMN_OF_JSON_PATH, EVENT_FIELDS, EVENT_TYPE

# Largest epoch ms, rounded, that leaves a BIGINT room for the end of its window.
MAX_TIMESTAMP_MS = 9_200_000_000_000_000_000

MESSAGE_COLUMNS = [
    "projectId",
    "channel",
    "senderId",
    *EVENT_FIELDS,
    "timestamp",
    "eventTime",
    "seq",
]


def non_empty(raw: DataFrame) -> DataFrame:
    """Drop empty values and tombstones."""
    return raw.filter(F.col("value").isNotNull() & (F.col("value") != ""))


def parse_events(
    raw: DataFrame,
    any_key_case: bool = False,
    missing_default: str | None = None,
) -> DataFrame:
    """One row per JSON object, every field as text.

    A line may hold an object or an array of objects. A line that is not JSON
    stays as one row of nulls with `malformed` set. `any_key_case` matches keys
    without regard to case, at the cost of a parse of each nested object.
    `missing_default` replaces null fields.
    """
    lines = non_empty(raw)
    if any_key_case:
        lines = _with_objects_any_case(lines)
    else:
        lines = lines.withColumn("objects", F.from_json("value", f"array<{EVENT_TYPE}>"))
    marked = lines.select("value", "seq", "objects", F.isnull("objects").alias("malformed"))
    rows = marked.select(
        "value",
        "seq",
        "malformed",
        F.posexplode_outer("objects").alias("position", "event"),
    ).filter(F.col("malformed") | F.col("position").isNotNull())
    fields = [
        F.col(f"event.{path}").alias(name) for path, name in COLUMN_OF_JSON_PATH.items()
    ]
    if missing_default is not None:
        fields = [
            F.when(~F.col("malformed"), F.coalesce(f, F.lit(missing_default))).alias(name)
            for f, name in zip(fields, COLUMN_OF_JSON_PATH.values(), strict=True)
        ]
    # The text itself is wanted only in quarantine, so good rows do not carry it.
    faulty = F.col("malformed") | readable_timestamp().isNull()
    return rows.select(
        *fields, F.struct("seq", "position").alias("seq"), "malformed", "value"
    ).withColumn("value", F.when(faulty, F.col("value")))


def readable_timestamp() -> Column:
    """The timestamp as BIGINT; null if it is no number or its time mark would overflow."""
    number = to_long("timestamp")
    return F.when(number.between(-MAX_TIMESTAMP_MS, MAX_TIMESTAMP_MS), number)


def bot_messages(events: DataFrame) -> DataFrame:
    """Keep what the bot handled for a known project."""
    return events.filter(_is_bot_message())


def usable(events: DataFrame) -> DataFrame:
    """Bot messages with a readable timestamp, in the canonical columns."""
    timed = bot_messages(events).withColumn("timestamp", readable_timestamp())
    return (
        timed.filter(F.col("timestamp").isNotNull())
        .withColumn("eventTime", event_time("timestamp"))
        .select(*MESSAGE_COLUMNS)
    )


def quarantined(events: DataFrame) -> DataFrame:
    """Lines that cannot be counted, with the reason and the original text."""
    untimed = _is_bot_message() & readable_timestamp().isNull()
    return events.filter(F.col("malformed") | untimed).select(
        F.when(F.col("malformed"), F.lit("malformed"))
        .otherwise(F.lit("bad_timestamp"))
        .alias("reason"),
        "value",
    )


def _is_bot_message() -> Column:
    handled_by_bot = ~present("humanSupport") | (F.col("humanSupport") == "false")
    return handled_by_bot & present("projectId")


def to_messages(raw: DataFrame, **options) -> DataFrame:
    """Raw lines to messages in one step."""
    return usable(parse_events(raw, **options))


def _with_objects_any_case(lines: DataFrame) -> DataFrame:
    def lowered(obj: Column) -> Column:
        """The object's keys in lower case, each folded once, with their values."""
        return F.transform(
            F.map_entries(obj),
            lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
        )

    def field(entries: Column, name: str) -> Column:
        # Of a repeated key the last value holds, as in the parse by exact keys.
        hits = F.filter(entries, lambda e: e["key"] == name.lower())
        return F.try_element_at(hits, F.lit(-1))["value"]

    def parsed(name: str) -> Callable[[Column], Column]:
        """Beside each object its inner one, parsed once for all its fields."""
        return lambda pair: F.struct(
            pair["obj"].alias("obj"),
            lowered(F.from_json(field(pair["inner"], name), "map<string,string>")).alias("inner"),
        )

    def event(pair: Column) -> Column:
        obj, status = pair["obj"], pair["inner"]
        leaves = ["final", "prevConversation", "previousStage"]
        payload = F.struct(
            F.struct(*[field(status, n).alias(n) for n in leaves]).alias("status")
        )
        flat = [p for p in COLUMN_OF_JSON_PATH if "." not in p]
        return F.struct(payload.alias("payload"), *[field(obj, n).alias(n) for n in flat])

    listed = F.when(
        F.ltrim("value").startswith("["), F.from_json("value", "array<map<string,string>>")
    )
    single = F.when(
        ~F.ltrim("value").startswith("["), F.from_json("value", "map<string,string>")
    )
    return (
        lines.withColumn("listed", listed)
        .withColumn("single", single)
        .withColumn(
            "maps",
            F.when(F.col("single").isNotNull(), F.array("single")).otherwise(F.col("listed")),
        )
        .withColumn("entries", F.transform("maps", lowered))
        .withColumn(
            "pairs", F.transform("entries", lambda e: F.struct(e.alias("obj"), e.alias("inner")))
        )
        .withColumn("pairs", F.transform("pairs", parsed("payload")))
        .withColumn("pairs", F.transform("pairs", parsed("status")))
        .withColumn("objects", F.transform("pairs", event))
    )
