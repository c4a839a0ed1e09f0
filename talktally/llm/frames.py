"""Small helpers on frames that several operators share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talktally.session import scratch_folder


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH, SMALL_BATCH = "8m", "2m"


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, a null text as an empty one."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared folder, so that no lost executor repeats the work."""
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_modules(spark: SparkSession, batch: str = BATCH) -> None:
    """Give the executors this package, once for each Spark application.

    Batches to and from Python are kept small where the session has not set their size:
    operators work on a few megabytes at a time, and larger batches only take memory.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_BYTES) in ("67108864b", BATCH):
        spark.conf.set(BATCH_BYTES, batch)
    if getattr(context, "_talktally_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    above = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="talktally-"), "talktally_modules.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in sorted(files):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, above))
    context.addPyFile(archive)
    context._talktally_shipped = True


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def trimmed(run: Run) -> Run:
    """The function of a task, after which its worker gives freed memory back to the machine.

    Spark reuses workers, and what one stage has freed would stay beside what the next needs.
    """

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim:
            trim(0)

    return whole


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the n + 1 places where its rows begin and end."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def row_blocks(
    ends: np.ndarray, most: int, most_rows: int | None = None
) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most that many bytes together; a longer row is a run of its own."""
    first, rows = 0, len(ends) - 1
    while first < rows:
        last = int(np.searchsorted(ends, ends[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows, first + (most_rows or rows))
        yield first, last
        first = last
