"""The eleven metrics, and user counts. Each metric takes messages, a table or a watermarked stream."""

from talktally.operators.counts import (
    intent_triggers,
    journey_nodes,
    merge_counts,
    message_count,
    message_counts,
    resp_type,
)
from talktally.operators.reach import (
    merge_user_sketches,
    user_counts,
    user_rollup,
    user_sketches,
    users_over,
)
from talktally.operators.sessions import merge_session_slices, session_count, session_slices
from talktally.operators.users import (
    distinct_users,
    drop_off_intent,
    drop_off_stage,
    merge_user_windows,
    open_sessions_first,
    open_sessions_last,
    time_spent,
    user_windows,
)

__all__ = [
    "distinct_users",
    "drop_off_intent",
    "drop_off_stage",
    "intent_triggers",
    "journey_nodes",
    "merge_counts",
    "merge_session_slices",
    "merge_user_sketches",
    "merge_user_windows",
    "message_count",
    "message_counts",
    "open_sessions_first",
    "open_sessions_last",
    "resp_type",
    "session_count",
    "session_slices",
    "time_spent",
    "user_counts",
    "user_rollup",
    "user_sketches",
    "user_windows",
    "users_over",
]
