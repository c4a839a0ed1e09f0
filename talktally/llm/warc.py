"""Web archives: records written by Spark, read back, and their index merged.

Each page is a WARC/1.0 record; the HTTP message in a response holds the payload, and a
revisit only refers to the response with an equal payload. Spark writes each partition's
records as one gzip file, sorted by URL key and time, so that every file is a sorted
capture run. Reading goes through Spark's text reader and the records' stated lengths.

The index merge deals captures by ranges of (URL key, time, page) and merges, in each
range, the sorted pieces of all runs with a tree of losers. Ranges are of bounded size,
as pages tell apart the captures of one URL.

A null or empty payload has no bytes and is a response. Equal payloads shorter than
`least_bytes` are responses all. A null URL is archived without target; line breaks in a
URL are percent-encoded. Repeated rows are archived as records of their own; if they are
the largest of their payload, all are responses. An empty table gives no rows. Other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talktally.llm.frames import stored
from talktally.llm.loser_tree import merged
from talktally.session import scratch_folder

LEAST_BYTES = 1000
FIRST_SECOND = 1_577_836_800  # pages have no time; their ids count seconds from 2020 on
ID_RANGE = 1_000_000_000
RANGE_ROWS = 50_000
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

CAPTURES = (
    "page_id long, url string, stamp string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, run string, place long, payload string"
)


def url_key(url: Column) -> Column:
    """The host's labels from the last to the first, then the path and query."""
    host = F.lower(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))
    rest = F.regexp_replace(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*|#.*$", "")
    labels = F.array_join(F.reverse(F.split(host, "\\.")), ",")
    return F.coalesce(F.concat(labels, F.lit(")"), rest), F.lit(""))


def capture_time(page_id: Column) -> Column:
    seconds = F.lit(FIRST_SECOND) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(ID_RANGE))
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def planned(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Each page with its payload, digest, kind of record and the page it refers to."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    page = pages.select(F.col("page_id").cast("long"), url.alias("url"), payload.alias("payload"))
    page = page.withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": F.sha1(F.col("payload").cast("binary")),
        }
    )
    large = page.where(F.col("payload_bytes") >= least_bytes)
    last = large.groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    last = last.where("n > 1").select("payload_digest", "last")
    own = F.col("last").isNull() | (F.col("payload_bytes") < least_bytes)
    own = own | F.coalesce(F.col("page_id") == F.col("last"), F.lit(False))
    return page.join(last, "payload_digest", "left").select(
        *page.columns,
        F.when(own, "response").otherwise("revisit").alias("record_type"),
        F.when(~own, F.col("last")).alias("refers_to"),
    )


def record_text(planned_pages: DataFrame) -> Column:
    """A record without the blank lines at its end."""

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    def of_page(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))

    whole = F.col("record_type") == "response"
    block = F.concat(F.lit(HTTP_HEAD), F.when(whole, F.col("payload")).otherwise(""))
    return F.concat(
        F.lit("WARC/1.0\r\n"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", of_page(F.col("page_id"))),
        header("WARC-Date", capture_time(F.col("page_id"))),
        header("WARC-Target-URI", F.col("url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        header("WARC-Payload-Length", F.col("payload_bytes")),
        header("WARC-Refers-To", of_page(F.col("refers_to"))),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )


def write_archive(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """One gzip file of records for each partition, each sorted by URL key and time."""
    records = planned(pages, least_bytes)
    records = records.sortWithinPartitions(
        url_key(F.col("url")), capture_time(F.col("page_id")), "page_id"
    )
    writer = records.select(record_text(records).alias("value")).write
    writer.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def _parsed(head: bytes, block: bytes, run: str, place: int, with_payload: bool) -> tuple:
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.0":
        raise ValueError(f"no record at {place} of {run}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(fields["WARC-Payload-Length"])
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.split(b"\r\n\r\n", 1)[1]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload and digest differ at {place} of {run}")
    pages = (fields.get(n) for n in ("WARC-Record-ID", "WARC-Refers-To"))
    page, refers_to = (int(p[len("<urn:page:") : -1]) if p else None for p in pages)
    shown = payload.decode("utf-8") if payload is not None and with_payload else None
    kind, uri = fields["WARC-Type"], fields.get("WARC-Target-URI")
    return page, uri, fields["WARC-Date"], size, digest, kind, refers_to, run, place, shown


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The captures of all files, each with its file and place there."""
    names = [f.split(" ")[0] for f in CAPTURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, place, left = None, 0, bytearray()
        for batch in batches:
            files = batch.column(0)
            out, at = [], 0
            while at < len(batch):
                if files[at].as_py() != file:
                    file, place, left = files[at].as_py(), 0, bytearray()
                stop = at + 1
                while stop < len(batch) and files[stop].as_py() == file:
                    stop += 1
                for line in batch.column(1).slice(at, stop - at):
                    left += line.as_buffer()
                    left += b"\n"
                at, done = stop, 0
                while (body := left.find(b"\r\n\r\n", done)) >= 0:
                    head = bytes(left[done:body])
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    end = body + 4 + size + 4
                    if end > len(left):
                        break
                    block = bytes(left[body + 4 : end - 4])
                    out.append(_parsed(head, block, file, place, with_payload))
                    place, done = place + end - done, end
                del left[:done]
            yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in out], _ARROW)

    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("_metadata.file_path", "value").mapInArrow(run, CAPTURES)


_ARROW = pa.schema(
    [
        (name, pa.int64() if kind == "long" else pa.string())
        for name, kind in (f.split(" ") for f in CAPTURES.split(", "))
    ]
)


def merged_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures with their position in the order of URL key, time and page.

    captures are sorted within each run; other columns than run are carried along.
    """
    keyed = captures.withColumn("url_key", url_key(F.col("url")))
    names = keyed.columns
    order = [names.index(n) for n in ("url_key", "stamp", "page_id")]
    run_at = names.index("run")
    schema = f"{', '.join(f'`{n}` {t}' for n, t in keyed.dtypes)}, range int, rank long"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(batches)
        if not tables:
            return
        table = pa.Table.from_batches(tables)
        url_keys, stamps, pages = (table.column(i).to_pylist() for i in order)
        runs: dict[str, list[tuple]] = {}
        for at, run in enumerate(table.column(run_at).to_pylist()):
            # A page without id sorts first, as a null does in Spark.
            page = (pages[at] is not None, pages[at] or 0)
            runs.setdefault(run, []).append((url_keys[at], stamps[at], page, at))
        for pieces in runs.values():
            pieces.sort()  # a shuffle may deliver a run's blocks in another order
        places = [item[-1] for item in merged(runs[name] for name in sorted(runs))]
        found = table.take(pa.array(places)).combine_chunks()
        found = found.append_column(
            "range", pa.array([TaskContext.get().partitionId()] * len(places), pa.int32())
        ).append_column("rank", pa.array(range(len(places)), pa.int64()))
        yield from found.to_batches(max_chunksize=10_000)

    ranges = max(1, -(-captures.count() // range_rows))
    dealt = keyed.repartitionByRange(ranges, "url_key", "stamp", "page_id")
    found = stored(dealt.mapInArrow(merge, schema), "index")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = found.groupBy("range").agg(F.count("*").alias("rows"))
    # One row for each range of tens of thousands of captures.
    begins = counts.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("begin"))
    position = (F.col("begin") + F.col("rank")).alias("position")
    return found.join(F.broadcast(begins), "range").select(*names, position)


def archived(
    pages: DataFrame, least_bytes: int = LEAST_BYTES, path: str | None = None
) -> DataFrame:
    """Write all pages as archives, read them back and merge the index of the captures."""
    spark = pages.sparkSession
    path = path or scratch_folder(spark, "warc")
    write_archive(pages, path, least_bytes)
    captures = stored(read_archive(spark, path, with_payload=False).drop("payload"), "captures")
    return merged_index(captures)
