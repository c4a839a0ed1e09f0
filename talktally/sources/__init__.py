"""Where raw events come from, and how they become messages."""

from talktally.sources.events_table import events_as_messages, events_as_raw
from talktally.sources.kafka import read_kafka, stream_kafka
from talktally.sources.parsing import (
    bot_messages,
    non_empty,
    parse_events,
    quarantined,
    to_messages,
    usable,
)
from talktally.sources.text import read_lines, stream_lines

__all__ = [
    "bot_messages",
    "events_as_messages",
    "events_as_raw",
    "non_empty",
    "parse_events",
    "quarantined",
    "read_kafka",
    "read_lines",
    "stream_kafka",
    "stream_lines",
    "to_messages",
    "usable",
]
