"""Names, tags and types shared by every part of the engine."""

from __future__ import annotations

# Default window, metric tags, status names, response types and
# node states are part of the data contract and must not change.
DEFAULT_WINDOW_MS = 300_000
MISSING_MARK = "EMPTY"

MESSAGE_COUNT = "messageCount"
SESSION_COUNT = "sessionCount"
DISTINCT_USERS = "distinctUsers"
TIME_SPENT = "timeSpent"
OPEN_SESSIONS = "openSessions"
RESPONSE_TYPE = "respType"
DROP_OFF_INTENT = "dropOffIntentCount"
DROP_OFF_STAGE = "dropOffStageCount"
INTENT_TRIGGER = "intentTriggerCount"
JOURNEY_NODES = "journeyNodesCount"
ALL_EVENTS = "allEvents"
RAW_EVENTS = "eventSourcedData"

RESPONSE_TYPE_OF_STATUS = {
    "cancel": "CANCELLED",
    "nextStart": "INTENT-TRIGGERED",
    "inFlowNextValidated": "JOURNEY-VALID",
    "inFlowPrevious": "JOURNEY-VALID",
    "inFlowNextInvalidated": "JOURNEY-INVALID",
    "inFlowNextGhost": "JOURNEY-GHOST",
    "cancelStuck": "JOURNEY-STUCK",
    "nextOptions": "OPTIONS",
}
FALLBACK_RESPONSE_TYPE = "FALLBACK"

STATUS_VALIDATED = "inFlowNextValidated"
STATUS_INVALIDATED = "inFlowNextInvalidated"
STATUS_GHOST = "inFlowNextGhost"
STATUS_START = "nextStart"
FLOW_CONVERSATION = "flow"
VALID_NODE = "validNode"
INVALID_NODE = "invalidNode"

# JSON path of a raw event -> canonical message column. The names shift:
# the JSON conversationId is the intent, the JSON intentName is what was detected.
COLUMN_OF_JSON_PATH = {
    "projectId": "projectId",
    "filterCode": "channel",
    "senderId": "senderId",
    "payload.status.final": "status",
    "payload.status.prevConversation": "prevConversationType",
    "payload.status.previousStage": "previousStageName",
    "conversationId": "intentName",
    "intentName": "intentDetected",
    "stageName": "stageName",
    "timestamp": "timestamp",
    "requestAssistance": "humanSupport",
}

# One raw event; every leaf is text, so numbers and booleans arrive as written.
EVENT_TYPE = (
    "struct<projectId:string,filterCode:string,senderId:string,"
    "payload:struct<status:struct<final:string,prevConversation:string,previousStage:string>>,"
    "conversationId:string,intentName:string,stageName:string,"
    "timestamp:string,requestAssistance:string>"
)

# What a user was doing at one message, as reported for open sessions.
EVENT_FIELDS = [
    "status",
    "prevConversationType",
    "previousStageName",
    "intentName",
    "intentDetected",
    "stageName",
]
CHANNEL_KEYS = ["projectId", "channel"]
CHANNEL_WINDOW = [*CHANNEL_KEYS, "timeMark"]
USER_WINDOW = [*CHANNEL_WINDOW, "senderId"]
