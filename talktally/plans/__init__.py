"""Groups of metrics, the stored state they share, documents and archives."""

from talktally.plans.archive import (
    all_events,
    all_events_documents,
    event_sourcing,
    raw_archive,
    write_archive,
    write_raw_archive,
)
from talktally.plans.compaction import CompactedStore
from talktally.plans.groups import (
    GROUPS,
    detailed,
    engagement,
    metric_groups,
    performance,
)
from talktally.plans.reach import read_user_sketches, write_user_sketches
from talktally.plans.report import dry_run_counts, metric_documents, tag_of
from talktally.plans.state import (
    MetricState,
    build_state,
    compact_state,
    metrics_of,
    read_state,
    write_state,
)

__all__ = [
    "GROUPS",
    "CompactedStore",
    "MetricState",
    "all_events",
    "all_events_documents",
    "build_state",
    "compact_state",
    "detailed",
    "dry_run_counts",
    "engagement",
    "event_sourcing",
    "metric_documents",
    "metric_groups",
    "metrics_of",
    "performance",
    "raw_archive",
    "read_state",
    "read_user_sketches",
    "tag_of",
    "write_archive",
    "write_raw_archive",
    "write_state",
    "write_user_sketches",
]
