"""Compaction of stored state, only of the dates that have changed.

A store of many batches has each date in many folders, and every read merges them all. A
compaction merges what batches since the last one hold: of each date that they touch, their
rows and the compacted ones of that date. Other dates stay as they are, so its cost follows
the new batches and not the age of the store.

Each compaction writes a generation, named by the last batch that it has merged, and after
that the list of its dates. A date is read from its newest listed generation, and batches
that no generation has from the live store. A compaction that stopped half way is not listed,
and the next one of the same batches replaces it, so that no batch is merged twice. Folders of
generations that are no date's newest any more can be deleted.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from talktally.plans.state import FOLDER_FIELDS, MetricState, merge_state, table_path, write_state

_NONE = -1  # the generation before the first batch


def _read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows under a path; none where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class CompactedStore:
    """Where batches write their state (`live`), where generations go, and their settings.

    `like` gives settings and schemas: a state of any messages, as batches make it.
    """

    live: str
    compacted: str
    like: MetricState

    def _rows(self, spark: SparkSession, path: str, name: str) -> DataFrame:
        fields = self.like.tables()[name].schema.fields
        folder = table_path(path, name, self.like.window_ms, self.like.gap_ms)
        return _read(spark, folder, StructType([*fields, *FOLDER_FIELDS]))

    def _home(self) -> str:
        # Generations of one gap know nothing of those of another.
        return f"{self.compacted}/gap_ms={self.like.gap_ms}"

    def _list_path(self) -> str:
        return table_path(self._home(), "generations", self.like.window_ms, self.like.gap_ms)

    def _newest(self, spark: SparkSession) -> DataFrame:
        """event_date and batch_id, the newest generation that lists the date."""
        listed = _read(spark, self._list_path(), "event_date date, batch_id bigint")
        return listed.groupBy("event_date").agg(F.max("batch_id").alias("batch_id"))

    def _last(self, spark: SparkSession) -> int:
        found = self._newest(spark).agg(F.max("batch_id")).first()[0]
        return _NONE if found is None else found

    def _compacted_rows(self, spark: SparkSession, name: str) -> DataFrame:
        # Both columns are folders, so Spark reads only the folders that the list names.
        return self._rows(spark, self._home(), name).join(
            self._newest(spark), ["event_date", "batch_id"], "left_semi"
        )

    def _state(self, tables: dict[str, DataFrame]) -> MetricState:
        bare = {name: table.drop("event_date", "batch_id") for name, table in tables.items()}
        return merge_state(replace(self.like, **bare))

    def compact(self, spark: SparkSession, upto: int | None = None) -> int:
        """Merge the batches after the last compaction up to that one; the last one merged.

        Without `upto`, all but the newest batch, which may still be being written.
        """
        last = self._last(spark)
        live = {name: self._rows(spark, self.live, name) for name in self.like.tables()}
        if upto is None:
            newest = [t.agg(F.max("batch_id")).first()[0] for t in live.values()]
            upto = max((n for n in newest if n is not None), default=last + 1) - 1
        if upto <= last:
            return last
        new = {n: t.where(F.col("batch_id").between(last + 1, upto)) for n, t in live.items()}
        touched = reduce(DataFrame.union, [t.select("event_date") for t in new.values()]).distinct()
        merged = self._state(
            {
                name: table.unionByName(
                    self._compacted_rows(spark, name).join(touched, "event_date", "left_semi")
                )
                for name, table in new.items()
            }
        )
        write_state(merged, self._home(), upto)
        touched.write.mode("overwrite").parquet(f"{self._list_path()}/batch_id={upto}")
        return upto

    def read(
        self, spark: SparkSession, from_date: str | None = None, to_date: str | None = None
    ) -> MetricState:
        """The state of all batches; dates bound the windows read, as in `read_state`."""
        last = self._last(spark)

        def dated(table: DataFrame) -> DataFrame:
            if from_date is not None:
                table = table.where(F.col("event_date") >= F.lit(from_date).cast("date"))
            if to_date is not None:
                table = table.where(F.col("event_date") <= F.lit(to_date).cast("date"))
            return table

        return self._state(
            {
                name: dated(self._compacted_rows(spark, name)).unionByName(
                    dated(self._rows(spark, self.live, name).where(F.col("batch_id") > last))
                )
                for name in self.like.tables()
            }
        )
