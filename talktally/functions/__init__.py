"""Column expressions. Everything here is built-in Spark SQL, no Python runs per row."""

from talktally.functions.classify import node_state, response_type, trigger_intent
from talktally.functions.documents import collection_name, document, strip_backslashes
from talktally.functions.presence import missing_to_empty, only, present
from talktally.functions.timing import event_time, time_mark, to_long, zoned_text

__all__ = [
    "collection_name",
    "document",
    "event_time",
    "missing_to_empty",
    "node_state",
    "only",
    "present",
    "response_type",
    "strip_backslashes",
    "time_mark",
    "to_long",
    "trigger_intent",
    "zoned_text",
]
