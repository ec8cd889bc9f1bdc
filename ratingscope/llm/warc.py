"""WARC archives: writing pages as records, reading them back, segment reassembly.

Writing. Payloads go into HTTP responses with chunked transfer framing. A block longer than
one segment is split: the first record carries ``WARC-Segment-Number: 1``, the others are
``continuation`` records with the origin's id, and the last one gives the total length.
Equal payloads of some length are stored once; later ones become ``revisit`` records. A
partition packs its records into rows of some megabytes, and Spark's own text writer puts
them into files, so any store that Spark writes to will do. A record ends with two line ends;
the writer adds the second one of a row's last record.

Reading. Spark reads the files as binary, some megabytes each; a small parser walks the
records. Segments are grouped by origin id (one record's segments, never more), ordered by
number, checked against the total length and joined; then the chunked framing is undone.

Edge cases. Null html is an empty payload. A null url is left out of the header, any other one
is percent-encoded where a header cannot hold it. Rows with the same id and payload are all of
the type of the first. Null page_ids come after all others. Broken archives raise an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workdir import materialized, new_path

LEAST = 100  # Fixed value of the task: bytes from which equal payloads are stored once.
SEGMENT = 256 * 1024  # bytes of a block in one record
CHUNK = 8 * 1024  # bytes of a chunk
PACK = 4 << 20  # bytes of records in one written row
ROWS_A_FILE = 8
END = b"\r\n"
RECORDS = "page_id long, record_id string, kind string, origin string, number int, total long, digest string, refers_to string, block binary"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[a : a + size]), payload[a : a + size]) for a in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        line = body.index(END, at)
        size = int(body[at:line].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        parts.append(body[line + 2 : line + 2 + size])
        at = line + 2 + size
        if len(parts[-1]) != size or body[at : at + 2] != END:
            raise ValueError("a chunk is cut short")
        at += 2


def record(headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("ascii") + END + END + block + END + END


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    at = 0
    while at < len(data):
        stop = data.index(END + END, at)
        first, *lines = data[at:stop].decode("ascii").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        size = int(headers["content-length"])
        block = data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size + 4
        if len(block) != size or data[at - 4 : at] != END + END:
            raise ValueError("a record is cut short")
        yield headers, block


def page_records(page_id: int | None, url: str | None, payload: bytes, copy: str, first: int | None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page. ``first`` is the page whose response this one revisits;
    ``copy`` tells rows apart that repeat id and payload."""
    digest = hashlib.sha256(payload).hexdigest()
    name = f"{page_id}:{digest[:16]}"
    common = {"WARC-Page-Id": "" if page_id is None else str(page_id), "WARC-Page-Copy": copy, "WARC-Payload-Digest": "sha256:" + digest}
    if url is not None:
        common["WARC-Target-URI"] = quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if first is not None:
        yield record({"WARC-Type": "revisit", "WARC-Record-ID": f"<urn:page:{name}>", **common, "WARC-Refers-To": f"<urn:page:{first}:{digest[:16]}>"}, http)
        return
    block = http + chunked(payload)
    parts = [block[a : a + segment] for a in range(0, len(block), segment)]
    for number, part in enumerate(parts, 1):
        headers = {"WARC-Type": "response" if number == 1 else "continuation", "WARC-Record-ID": f"<urn:page:{name}{'' if number == 1 else f':{number}'}>", **common}
        if len(parts) > 1:
            headers["WARC-Segment-Number"] = str(number)
        if number > 1:
            headers["WARC-Segment-Origin-ID"] = f"<urn:page:{name}>"
        if number > 1 and number == len(parts):
            headers["WARC-Segment-Total-Length"] = str(len(block))
        yield record(headers, part)


def write_archives(pages: DataFrame, path: str, *, least: int = LEAST, segment: int = SEGMENT) -> None:
    """Write (page_id, url, html) rows as gzipped WARC files below ``path``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.cast("binary").alias("payload"), F.sha2(html.cast("binary"), 256).alias("digest"))
    # Pages met more than once: one row per payload, summed up before the shuffle.
    again = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    # Only these digests travel with page texts; a common one is split by adaptive execution.
    marked = rows.join(again.select("digest", "first"), "digest", "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = marked.select("page_id", "url", "payload", F.when(other, F.col("first")).alias("first"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[bytes] = []
        size, count, task = 0, 0, TaskContext.get().partitionId()

        def row() -> pa.RecordBatch:
            # Without the last line end, which the writer adds.
            return pa.RecordBatch.from_arrays([pa.array([b"".join(made)[:-2]], type=pa.binary())], names=["value"])

        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for page_id, url, payload, first in zip(*columns):
                count += 1
                for one in page_records(page_id.as_py(), url.as_py(), payload.as_py(), f"{task}-{count}", first.as_py(), segment):
                    made.append(one)
                    size += len(one)
                    if size >= PACK:
                        yield row()
                        made, size = [], 0
        if made:
            yield row()

    text = marked.mapInArrow(packed, "value binary").select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", ROWS_A_FILE).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``, one row each (columns of RECORDS)."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_id", "kind", "origin", "number", "total", "digest", "refers_to", "block"]
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for content in batch.column(0):
                data = zlib.decompress(content.as_py(), 47)
                rows, size = [], 0
                for h, block in parse(data):
                    total, number = h.get("warc-segment-total-length"), h.get("warc-segment-number")
                    rows.append((int(h["warc-page-id"]) if h["warc-page-id"] else None, h["warc-record-id"], h["warc-type"], h.get("warc-segment-origin-id", h["warc-record-id"]) + " " + h["warc-page-copy"], int(number) if number else None, int(total) if total else None, h["warc-payload-digest"].removeprefix("sha256:"), h.get("warc-refers-to"), block))
                    size += len(block)
                    if size >= PACK:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(records, RECORDS)


def assembled(records: DataFrame) -> DataFrame:
    """Records with the segments of each origin joined in order and checked.

    Only segmented records are shuffled. A group is the segments of one record.
    """
    alone = records.where("number is null").select("page_id", "record_id", "kind", "digest", "refers_to", "block")
    parts = records.where("number is not null").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        F.max("page_id").alias("page_id"),
        F.max("digest").alias("digest"),
    )
    # Segments must be 1, 2, .. without a gap, and as long together as the last one says.
    whole = F.aggregate("parts", F.lit(b""), lambda all, p: F.concat(all, p["block"]))
    right = F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1), F.size("parts"))
    parts = parts.withColumn("block", whole)
    right = right & (F.octet_length("block") == F.col("total"))
    checked = F.when(F.coalesce(right, F.lit(False)), F.col("block")).otherwise(F.raise_error(F.concat(F.lit("segments missing of "), "origin")))
    parts = parts.select("page_id", F.col("origin").alias("record_id"), F.lit("response").alias("kind"), "digest", F.lit(None).cast("string").alias("refers_to"), checked.alias("block"))
    return alone.unionByName(parts)


def payload_of(block: Column) -> Column:
    """Payload of an HTTP response block with chunked framing."""

    @F.arrow_udf("binary")
    def payloads(blocks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in blocks:
            yield pa.array([dechunked(b.as_py().split(END + END, 1)[1]) for b in batch], type=pa.binary())

    return payloads(block)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Archived pages: ``page_id, record_id, record_type, refers_to`` (a page_id), ``digest``
    (as the record's header has it) and ``payload`` (null for revisits)."""
    records = assembled(read_records(spark, path))
    answered = records.where("kind = 'response'").select("page_id", "record_id", "kind", "refers_to", "digest", payload_of(F.col("block")).alias("payload"))
    revisits = records.where("kind = 'revisit'").select("page_id", "record_id", "kind", "refers_to", "digest", F.lit(None).cast("binary").alias("payload"))
    both = answered.unionByName(revisits)
    to = F.regexp_extract("refers_to", r"<urn:page:(-?\d+):", 1).cast("long")
    return both.select("page_id", "record_id", F.col("kind").alias("record_type"), F.when(F.col("refers_to").isNotNull(), to).alias("refers_to"), "digest", "payload")


def archive_report(pages: DataFrame, work_dir: str | None = None) -> DataFrame:
    """Length and digest of every archived page's full payload, checked against its header.

    A revisit takes the length from the response it refers to, looked up in a table without
    payloads; both sides are shuffled for that join alone, so a hot response is split.
    """
    real = F.sha2("payload", 256)
    checked = F.when(real == F.col("digest"), real).otherwise(F.raise_error(F.concat(F.lit("wrong digest in "), "record_id")))
    slim = pages.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.when(F.col("payload").isNotNull(), checked).otherwise(F.col("digest")).alias("payload_digest"), "record_type", "refers_to")
    slim = materialized(slim, "warc-pages", work_dir)
    stored = slim.where("record_type = 'response'")
    length = stored.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    revisits = slim.where("record_type = 'revisit'").drop("payload_bytes").join(length, ["refers_to", "payload_digest"])
    return stored.unionByName(revisits)


def archive_and_read(pages: DataFrame, work_dir: str | None = None) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and report."""
    spark = pages.sparkSession
    path = new_path(spark, "warc", work_dir)
    write_archives(pages, path)
    return archive_report(read_pages(spark, path), work_dir)
