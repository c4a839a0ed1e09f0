"""Plain SQL for the registered queries, written for DuckDB and apart from the engine.

Only the rules that read `events` as messages are shared. Argmax is a row number,
sessions are lag over all rows, documents are built by the SQL engine's own JSON.
"""

from __future__ import annotations

from talktally.catalog import DAY_MS, HALF_HOUR_MS
from talktally.schema import DEFAULT_WINDOW_MS
from talktally.sources.events_table import FIELD_RULES

W = DEFAULT_WINDOW_MS
K = "projectId, channel, timeMark"
U = f"{K}, senderId"
EVENT = (
    "status, prevConversationType, previousStageName AS previousStage, intentName, "
    "intentDetected, stageName"
)


def _present(column: str) -> str:
    return f"({column} IS NOT NULL AND {column} NOT IN ('', 'EMPTY'))"


BOT = (
    f"((NOT {_present('humanSupport')}) OR humanSupport = 'false') "
    f"AND {_present('projectId')}"
)
RESPONSE = (
    "CASE WHEN status = 'cancel' THEN 'CANCELLED' "
    "WHEN status = 'nextStart' THEN 'INTENT-TRIGGERED' "
    "WHEN status IN ('inFlowNextValidated', 'inFlowPrevious') THEN 'JOURNEY-VALID' "
    "WHEN status = 'inFlowNextInvalidated' THEN 'JOURNEY-INVALID' "
    "WHEN status = 'inFlowNextGhost' THEN 'JOURNEY-GHOST' "
    "WHEN status = 'cancelStuck' THEN 'JOURNEY-STUCK' "
    "WHEN status = 'nextOptions' THEN 'OPTIONS' ELSE 'FALLBACK' END"
)
STATE = "CASE WHEN status = 'inFlowNextInvalidated' THEN 'invalidNode' ELSE 'validNode' END"
NODE = (
    f"{_present('intentName')} AND {_present('stageName')} AND {_present('previousStageName')} "
    "AND prevConversationType = 'flow' "
    "AND status IN ('inFlowNextValidated', 'inFlowNextInvalidated')"
)


def _trigger(ghost: str) -> str:
    return (
        f"CASE WHEN status = 'inFlowNextGhost' AND {_present(ghost)} THEN {ghost} "
        f"WHEN status = 'nextStart' AND {_present('intentName')} THEN intentName ELSE '' END"
    )


def _fields() -> str:
    rules = ", ".join(f"{rule} AS {name}" for name, rule in FIELD_RULES.items())
    return (
        f"f AS (SELECT event_id AS seq, {rules}, epoch_us(ts) // 1000 AS timestamp FROM "
        "(SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events))"
    )


def _messages(window: int = W) -> str:
    return (
        f"WITH {_fields()}, m AS (SELECT *, ((timestamp // {window}) + 1) * {window} "
        f"AS timeMark FROM f WHERE {BOT})"
    )


def _session_count(gap: int) -> str:
    return (
        f"SELECT {K}, CAST(sum(s) AS BIGINT) AS count FROM (SELECT {U}, "
        f"1 + sum(CASE WHEN timestamp - before > {gap} THEN 1 ELSE 0 END) AS s FROM "
        f"(SELECT *, lag(timestamp) OVER (PARTITION BY {U} ORDER BY timestamp, seq) AS before "
        f"FROM m) GROUP BY {U}) GROUP BY {K}"
    )


def _ranked(where: str, way: str) -> str:
    return (
        f"(SELECT *, row_number() OVER (PARTITION BY {U} ORDER BY timestamp {way}, seq {way}) "
        f"AS rn FROM m WHERE {where})"
    )


def _time_spent(span: int) -> str:
    return (
        f"SELECT {K}, CAST(sum(span) AS BIGINT) AS totalTime FROM (SELECT {U}, "
        f"max(timestamp) - min(timestamp) AS span FROM m GROUP BY {U}) "
        f"WHERE span <= {span} GROUP BY {K}"
    )


def _triggers(ghost: str) -> str:
    return (
        f"SELECT {K}, t AS intentName, count(*) AS count FROM "
        f"(SELECT {K}, {_trigger(ghost)} AS t FROM m) WHERE t <> '' AND t <> 'EMPTY' GROUP BY {K}, t"
    )


def _open_sessions(way: str, stamp: str, age: int) -> str:
    return (
        f"SELECT {U}, {EVENT}, timestamp AS {stamp} FROM {_ranked('true', way)} "
        f"WHERE rn = 1 AND timeMark - timestamp <= {age}"
    )


def metric_sql(window: int, gap: int) -> dict[str, str]:
    """Each metric over the messages `m`."""
    known_stage = f"{_present('intentName')} AND stageName IS NOT NULL"
    return {
        "message_count": f"SELECT {K}, count(*) AS count FROM m GROUP BY {K}",
        "distinct_users": f"SELECT DISTINCT {U} FROM m",
        "time_spent": _time_spent(window),
        "session_count": _session_count(gap),
        "resp_type": (
            f"SELECT {K}, {RESPONSE} AS responseType, count(*) AS count FROM m "
            f"GROUP BY {K}, responseType"
        ),
        "drop_off_intent": (
            f"SELECT {K}, intentName, count(*) AS count FROM "
            f"{_ranked(_present('intentName'), 'DESC')} WHERE rn = 1 GROUP BY {K}, intentName"
        ),
        "drop_off_stage": (
            f"SELECT {K}, intentName, stageName, count(*) AS count FROM "
            f"{_ranked(known_stage, 'DESC')} WHERE rn = 1 GROUP BY {K}, intentName, stageName"
        ),
        "journey_nodes": (
            f"SELECT {K}, {STATE} AS state, intentName, previousStageName, stageName, "
            f"count(*) AS count FROM m WHERE {NODE} "
            f"GROUP BY {K}, state, intentName, previousStageName, stageName"
        ),
        "intent_triggers": _triggers("stageName"),
        "intent_triggers_intended": _triggers("intentDetected"),
        "open_sessions_last": _open_sessions("DESC", "maxTimestamp", window),
        "open_sessions_first": _open_sessions("ASC", "minTimestamp", window),
    }


_TAG_AND_COLUMNS = {
    "message_count": ("messageCount", [*K.split(", "), "count"]),
    "distinct_users": ("distinctUsers", U.split(", ")),
    "time_spent": ("timeSpent", [*K.split(", "), "totalTime"]),
    "session_count": ("sessionCount", [*K.split(", "), "count"]),
    "resp_type": ("respType", [*K.split(", "), "responseType", "count"]),
    "drop_off_intent": ("dropOffIntentCount", [*K.split(", "), "intentName", "count"]),
    "drop_off_stage": (
        "dropOffStageCount",
        [*K.split(", "), "intentName", "stageName", "count"],
    ),
    "journey_nodes": (
        "journeyNodesCount",
        [
            *K.split(", "),
            "state",
            "intentName",
            "previousStageName AS previousStage",
            "stageName",
            "count",
        ],
    ),
    "intent_triggers": ("intentTriggerCount", [*K.split(", "), "intentName", "count"]),
}
_SESSION_COLUMNS = [
    *U.split(", "),
    "status",
    "prevConversationType",
    "previousStage",
    "intentName",
    "intentDetected",
    "stageName",
]
_TAG_AND_COLUMNS["open_sessions_last"] = ("openSessions", [*_SESSION_COLUMNS, "maxTimestamp"])
_TAG_AND_COLUMNS["open_sessions_first"] = ("openSessions", [*_SESSION_COLUMNS, "minTimestamp"])


def _json(columns: list[str]) -> str:
    pairs = []
    for column in columns:
        value, _, key = column.partition(" AS ")
        pairs.append(f"'{key or value}', {value}")
    return f"CAST(json_object({', '.join(pairs)}) AS VARCHAR)"


def _documents(window: int, gap: int, names: list[str] | None = None, source=None) -> str:
    sql = metric_sql(window, gap)
    parts = []
    for name, (tag, columns) in _TAG_AND_COLUMNS.items():
        if names is None or name in names:
            value = _json([*columns, f"{window} AS window", f"'{tag}' AS topic"])
            parts.append(
                f"SELECT '{tag}_{window // 1000}' AS collection, {value} AS value "
                f"FROM ({sql[name]})"
            )
    return f"{source or _messages(window)} " + " UNION ALL ".join(parts)


_RAW_KEYS = [
    "projectId",
    "channel AS filterCode",
    "senderId",
    "(CASE WHEN seq % 47 <> 0 THEN json_object('status', json_object('final', status, "
    "'prevConversation', prevConversationType, 'previousStage', previousStageName)) END) "
    "AS payload",
    "intentName AS conversationId",
    "intentDetected AS intentName",
    "stageName",
    "(concat(CASE WHEN seq % 43 = 0 THEN 't' ELSE '' END, timestamp)) AS timestamp",
    "humanSupport AS requestAssistance",
]


def _lines() -> str:
    line = _json(_RAW_KEYS)
    return (
        f"{_fields()}, lines AS (SELECT seq, CASE WHEN seq % 31 = 0 THEN '' "
        f"WHEN seq % 37 = 0 THEN left({line}, 20) "
        f"WHEN seq % 41 = 0 THEN concat('[', {line}, ']') ELSE {line} END AS value FROM f)"
    )


READABLE = "seq % 31 <> 0 AND seq % 37 <> 0"
_NO_PAYLOAD = ", ".join(
    f"CASE WHEN seq % 47 <> 0 THEN {c} END AS {c}"
    for c in ("status", "prevConversationType", "previousStageName")
)
_PARSED = (
    f"SELECT projectId, channel, senderId, {_NO_PAYLOAD}, intentName, intentDetected, "
    f"stageName, timestamp, seq FROM f WHERE {BOT} AND {READABLE} AND seq % 43 <> 0"
)
_ZONED = (
    "concat(strftime(make_timestamp((x + 19800000) * 1000), '%Y-%m-%dT%H:%M'), "
    "CASE WHEN x % 60000 = 0 THEN '' "
    "WHEN x % 1000 = 0 THEN concat(':', lpad(CAST((x // 1000) % 60 AS VARCHAR), 2, '0')) "
    "ELSE concat(':', lpad(CAST((x // 1000) % 60 AS VARCHAR), 2, '0'), '.', "
    "lpad(CAST(x % 1000 AS VARCHAR), 3, '0')) END, '+05:30[Asia/Calcutta]')"
)


def _zoned(x: str) -> str:
    return _ZONED.replace("x", x).replace(f"conca{x}", "concat")


def _user_counts(window: int) -> str:
    return f"{_messages(window)} SELECT {K}, count(*) AS users FROM (SELECT DISTINCT {U} FROM m) GROUP BY {K}"


def _user_rollup(window: int) -> str:
    none = "CAST(NULL AS VARCHAR)"
    return (
        f"{_messages(window)} SELECT 'channel' AS level, {K}, count(*) AS users "
        f"FROM (SELECT DISTINCT {U} FROM m) GROUP BY {K} UNION ALL "
        f"SELECT 'project', projectId, {none}, timeMark, count(*) FROM "
        "(SELECT DISTINCT projectId, timeMark, senderId FROM m) GROUP BY projectId, timeMark UNION ALL "
        f"SELECT 'all', {none}, {none}, timeMark, count(*) FROM "
        "(SELECT DISTINCT projectId, timeMark, senderId FROM m) GROUP BY timeMark"
    )


def _long_counts(window: int) -> str:
    none = "CAST(NULL AS VARCHAR)"
    sql = metric_sql(window, window)
    return (
        f"{_messages(window)} SELECT {K}, 'respType' AS metric, responseType, {none} AS state, "
        f"{none} AS intentName, {none} AS previousStageName, {none} AS stageName, count "
        f"FROM ({sql['resp_type']}) UNION ALL SELECT {K}, 'journeyNodesCount', {none}, state, "
        f"intentName, previousStageName, stageName, count FROM ({sql['journey_nodes']}) "
        f"UNION ALL SELECT {K}, 'intentTriggerCount', {none}, {none}, intentName, {none}, "
        f"{none}, count FROM ({sql['intent_triggers']})"
    )


def _user_windows(window: int) -> str:
    def winner(name: str, where: str, way: str) -> str:
        return f"{name} AS (SELECT * FROM {_ranked(where, way)} WHERE rn = 1)"

    def same(name: str) -> str:
        return " AND ".join(
            f"u.{c} IS NOT DISTINCT FROM {name}.{c}" for c in U.split(", ")
        )

    known = _present("intentName")
    parts = [
        winner("a", "true", "ASC"),
        winner("z", "true", "DESC"),
        winner("i", known, "DESC"),
        winner("g", f"{known} AND stageName IS NOT NULL", "DESC"),
    ]
    keys = ", ".join(f"u.{c} AS {c}" for c in U.split(", "))
    return (
        f"{_messages(window)}, {', '.join(parts)}, u AS (SELECT {U}, count(*) AS messages, "
        f"min(timestamp) AS min_ts, max(timestamp) AS max_ts FROM m GROUP BY {U}) "
        f"SELECT {keys}, messages, min_ts, max_ts, a.seq AS first_seq, z.seq AS last_seq, "
        "i.seq AS intent_seq, i.intentName AS intent, g.seq AS stage_seq, "
        f"g.stageName AS stage FROM u JOIN a ON {same('a')} JOIN z ON {same('z')} "
        f"LEFT JOIN i ON {same('i')} LEFT JOIN g ON {same('g')}"
    )


def all_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    small, day = metric_sql(W, W), metric_sql(DAY_MS, HALF_HOUR_MS)
    whole_day = metric_sql(DAY_MS, DAY_MS)
    for name in small:
        found[name] = f"{_messages()} {small[name]}"
        found[f"{name}_daily"] = f"{_messages(DAY_MS)} {whole_day[name]}"
        found[f"stream_final_{name}"] = f"{_messages(DAY_MS)} {whole_day[name]}"
        if name != "intent_triggers_intended":
            found[f"merged_{name}"] = f"{_messages(DAY_MS)} {day[name]}"
    daily = _messages(DAY_MS)
    all_columns = (
        "projectId, channel, timestamp, senderId, status, prevConversationType, "
        "previousStageName AS previousStage, intentName, intentDetected, stageName"
    )
    event_json = _json([*all_columns.split(", "), "'allEvents' AS topic"])
    performance = ["resp_type", "drop_off_intent", "drop_off_stage"]
    parsed_day = (
        f"WITH {_fields()}, m AS (SELECT *, ((timestamp // {DAY_MS}) + 1) * {DAY_MS} AS timeMark "
        f"FROM ({_PARSED}))"
    )
    parsed = (
        f"WITH {_fields()}, m AS (SELECT *, ((timestamp // {W}) + 1) * {W} AS timeMark "
        f"FROM ({_PARSED}))"
    )
    metric_order = [n for n in small if n != "intent_triggers_intended"]
    dry_run = " UNION ALL ".join(
        f"SELECT '{n}' AS metric, '{_TAG_AND_COLUMNS[n][0]}_300' AS collection, "
        f"count(*) AS documents FROM ({small[n]})"
        for n in metric_order
    )
    found |= {
        "session_count_gap30m": f"{daily} {_session_count(HALF_HOUR_MS)}",
        "session_count_gap1s": f"{daily} {_session_count(1000)}",
        "stream_final_session_count_gap30m": f"{daily} {_session_count(HALF_HOUR_MS)}",
        "time_spent_span1h": f"{daily} {_time_spent(3_600_000)}",
        "open_sessions_last_age1h": (
            f"{daily} {_open_sessions('DESC', 'maxTimestamp', 3_600_000)}"
        ),
        "user_counts": _user_counts(W),
        "user_counts_daily": _user_counts(DAY_MS),
        "stream_final_user_counts": _user_counts(DAY_MS),
        "user_rollup": _user_rollup(W),
        "user_rollup_daily": _user_rollup(DAY_MS),
        "user_sketches_daily": f"SELECT *, true AS near FROM ({_user_counts(DAY_MS)})",
        "user_windows": _user_windows(DAY_MS),
        "message_counts": _long_counts(DAY_MS),
        "session_slices": (
            f"{daily} SELECT {U}, timestamp - timestamp % {HALF_HOUR_MS} AS slice, "
            f"min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM m GROUP BY {U}, slice"
        ),
        "stored_state_metrics": _documents(DAY_MS, HALF_HOUR_MS),
        "compacted_state_metrics": _documents(DAY_MS, HALF_HOUR_MS),
        "ingest_filter": f"WITH {_fields()} {_PARSED}",
        "ingest_any_key_case": f"WITH {_fields()} {_PARSED}",
        "ingest_quarantine": (
            f"WITH {_lines()} SELECT 'malformed' AS reason, value FROM lines "
            "WHERE seq % 37 = 0 AND value <> '' UNION ALL "
            "SELECT 'bad_timestamp', value FROM lines JOIN f USING (seq) "
            f"WHERE seq % 43 = 0 AND {READABLE} AND {BOT}"
        ),
        "resp_type_from_raw": f"{parsed} {small['resp_type']}",
        "all_events": f"{_messages()} SELECT {all_columns}, 'allEvents' AS topic FROM m",
        "all_events_documents": (
            f"{_messages()} SELECT 'allEvents' AS collection, {event_json} AS value FROM m"
        ),
        "raw_archive": f"WITH {_lines()} SELECT value FROM lines WHERE value <> ''",
        "raw_archive_files": f"WITH {_lines()} SELECT value FROM lines WHERE value <> ''",
        "fan_out_documents": (
            f"{_messages()}, d AS (SELECT 'allEvents' AS collection, {event_json} AS value FROM m) "
            "SELECT *, 'parquet' AS store FROM d UNION ALL SELECT *, 'json' AS store FROM d"
        ),
        "stream_restarted_documents": _documents(
            DAY_MS, HALF_HOUR_MS, performance, source=parsed_day
        ),
        "batch_lag": (
            f"{_messages()} SELECT timeMark AS batch_time, {_zoned(f'(timeMark - {W})')} "
            f"AS from_time, {_zoned('timeMark')} AS to_time, count(*) AS messages, "
            "min(timestamp) AS min_ts, max(timestamp) AS max_ts, "
            "(timeMark - max(timestamp)) // 1000 AS delay_s FROM m GROUP BY timeMark"
        ),
        "scalar_functions": (
            f"{_messages()} SELECT seq, {_present('intentName')} AS intent_present, "
            "CASE WHEN stageName IS NULL OR stageName = '' THEN 'EMPTY' ELSE stageName END "
            "AS stage_or_empty, CASE WHEN seq % 2 <> 0 THEN timestamp END AS parsed, "
            f"timeMark AS mark, {_zoned('timestamp')} AS zoned, {RESPONSE} AS response_type, "
            f"{STATE} AS node_state, {_trigger('stageName')} AS trigger_intent, "
            f"{_trigger('intentDetected')} AS trigger_intended, "
            "concat(status, senderId) AS stripped FROM m"
        ),
        "metric_documents": _documents(W, W),
        "kafka_records": (
            f"SELECT collection AS topic, value FROM ({_documents(W, W, performance)})"
        ),
        "keyed_kafka_records": (
            f"{_messages()} SELECT 'allEvents' AS topic, 'allEvents' AS key, "
            f"{event_json} AS value, CAST(seq % 12 % 4 AS INTEGER) AS partition FROM m"
        ),
        "dry_run_counts": f"{_messages()} {dry_run}",
        "stream_partial_documents": _documents(DAY_MS, HALF_HOUR_MS, source=parsed_day),
    }
    return found
