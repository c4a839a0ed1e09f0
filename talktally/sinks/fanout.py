"""The same rows to several sinks, computed once."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def fan_out(rows: DataFrame, writers: Iterable[Callable[[DataFrame], None]]) -> None:
    """Give `rows` to each writer in turn.

    Rows are kept on executors, on disk where memory is short, and computed again
    from their source if an executor is lost.
    """
    targets = list(writers)
    if len(targets) < 2:
        for write in targets:
            write(rows)
        return
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for write in targets:
            write(kept)
    finally:
        kept.unpersist()
