"""Partial mode: each micro-batch adds mergeable state, and late rows just merge in.

This keeps the original's cadence, one set of results per batch, but makes them
additive: `read_state` over all batches equals one batch over all data.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from talktally.operators.reach import user_sketches
from talktally.plans.archive import event_sourcing, write_archive, write_raw_archive
from talktally.plans.compaction import CompactedStore
from talktally.plans.groups import GROUPS
from talktally.plans.reach import write_user_sketches
from talktally.plans.report import metric_documents, typed_documents
from talktally.plans.state import build_state, metrics_of, read_state, write_state
from talktally.schema import DEFAULT_WINDOW_MS
from talktally.sinks import fan_out, write_batch_parquet
from talktally.sources.parsing import parse_events, quarantined, usable
from talktally.streaming.lag import batch_lag


Sink = Callable[[DataFrame, int], None]
TableSink = Callable[[str, DataFrame, int], None]


@dataclass(frozen=True)
class BatchJob:
    """What to do with each micro-batch of raw lines (value, seq).

    `store` is a folder that all executors see. Under it go `state`, `lag` and, where
    asked for, `quarantine`, `archive`, `raw` and `reach` (user sketches). With
    `compact_every`, that many batches are merged at a time into `compacted`, which a
    `CompactedStore` reads. `document_sinks` receive the
    batch's own metric documents (collection, value), which are not upserted: use
    the state for totals. `table_sinks` receive the same rows as typed tables, one call
    for each collection. Both carry the batch's id and time; a retried batch has its
    first id, by which a consumer leaves out what it has. `archive_sinks` receive every
    raw line and every message as documents.
    """

    store: str
    groups: tuple[str, ...] = tuple(GROUPS)
    window_ms: int = DEFAULT_WINDOW_MS
    gap_ms: int | None = None
    ghost_col: str = "stageName"
    keep_quarantine: bool = True
    keep_archive: bool = False
    keep_raw: bool = False
    keep_reach: bool = False
    compact_every: int | None = None
    parse_options: dict = field(default_factory=dict)
    document_sinks: tuple[Sink, ...] = ()
    table_sinks: tuple[TableSink, ...] = ()
    archive_sinks: tuple[Sink, ...] = ()
    clock: Callable[[], float] = time.time

    def __call__(self, raw: DataFrame, batch_id: int) -> None:
        now = int(self.clock() * 1000)
        kept = self.keep_raw or self.archive_sinks
        if kept:
            raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._run(raw, batch_id, now)
        finally:
            if kept:
                raw.unpersist()

    def _run(self, raw: DataFrame, batch_id: int, now: int) -> None:
        if self.keep_raw:
            write_raw_archive(raw, f"{self.store}/raw", now, batch_id)
        # Parsing is the dear part, so every output of the batch reads it from here.
        events = parse_events(raw, **self.parse_options).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.keep_quarantine:
                write_batch_parquet(quarantined(events), f"{self.store}/quarantine", batch_id)
            messages = usable(events)
            lag = batch_lag(messages, F.lit(now), self.window_ms)
            write_batch_parquet(lag, f"{self.store}/lag", batch_id)
            if self.keep_archive:
                write_archive(messages, f"{self.store}/archive", batch_id)
            if self.keep_reach:
                sketches = user_sketches(messages, self.window_ms)
                write_user_sketches(sketches, f"{self.store}/reach", self.window_ms, batch_id)
            if self.archive_sinks:
                for documents in event_sourcing(raw, messages).values():
                    self._send(documents, self.archive_sinks, batch_id)
            self._write_metrics(messages, batch_id, now)
        finally:
            events.unpersist()

    def _write_metrics(self, messages: DataFrame, batch_id: int, now: int) -> None:
        if not self.groups:
            return
        state = build_state(
            messages, self.groups, self.window_ms, self.gap_ms, self.ghost_col
        )
        path = f"{self.store}/state"
        write_state(state, path, batch_id, gather_dates=False)
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            # This batch may be tried again, so it is left to the next compaction.
            store = CompactedStore(path, f"{self.store}/compacted", state)
            store.compact(messages.sparkSession, batch_id - 1)
        if self.document_sinks or self.table_sinks:
            # From what was just stored, so that nothing is aggregated again.
            stored = read_state(
                messages.sparkSession,
                path,
                self.window_ms,
                self.gap_ms,
                batch_id=batch_id,
                groups=self.groups,
                like=state,
            )
            stamps = {
                "batchId": F.lit(batch_id).cast("bigint"),
                "batchTime": F.lit(now).cast("bigint"),
            }
            metrics = metrics_of(stored, self.groups)
            if self.document_sinks:
                documents = metric_documents(metrics, self.window_ms, stamps)
                self._send(documents, self.document_sinks, batch_id)
            for collection, table in typed_documents(metrics, self.window_ms, stamps):
                writers = [
                    lambda t, send=send, name=collection: send(name, t, batch_id)
                    for send in self.table_sinks
                ]
                fan_out(table, writers)

    @staticmethod
    def _send(documents: DataFrame, targets: tuple[Sink, ...], batch_id: int) -> None:
        fan_out(documents, [lambda d, send=send: send(d, batch_id) for send in targets])


def start_partial(
    raw: DataFrame,
    job: BatchJob,
    checkpoint: str,
    every: str | None = "300 seconds",
) -> StreamingQuery:
    """Run `job` on a stream of raw lines; `every=None` takes what is there and stops.

    The checkpoint keeps source offsets, so a restart goes on where it stopped.
    """
    writer = raw.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()
