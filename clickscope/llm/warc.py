"""WARC 1.1 writing, and a salvage reader that recovers the sound records of damaged archives.

Writing: one record per page. Of pages with equal payloads of at least REVISIT_BYTES bytes, the one with
the smallest page_id is a response, the others are revisits that refer to it. A record is a gzip member of
its own, so damage to one leaves the others readable. The members are written as they are by Spark's text
writer (its line separator is the zero byte that ends a member), so files appear by the usual task commit,
wherever the path lives; they are gzip files, though named .txt. An archive holds at most `per_archive`
records.

Reading: an archive is walked member by member (gzip) and record by record. A record is sound if its
version line, headers, Content-Length, closing blank lines and digests hold. After a failed check the
reader searches for the next position that could start a record (a version line; in a compressed archive
also the next gzip member), goes on there and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.llm.common import settle
from clickscope.runtime import scratch_path

REVISIT_BYTES = 100
ARCHIVE_RECORDS = 2_000
END = "\r\n\r\n"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MEMBER = b"\x1f\x8b\x08"
STEP = 1 << 16
DATE = "2024-01-01T00:00:00Z"


def revisit_plan(pages: DataFrame) -> DataFrame:
    """pages with payload_bytes, payload_digest and refers_to (null: a response).

    Payloads are counted and grouped by digest alone; pages themselves are not shuffled by payload. A null
    html is an empty payload; a null page_id sorts last, so it is referred to only if there is no other.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", "html", F.octet_length(html).cast("long").alias("payload_bytes"),
                        F.sha2(html.cast("binary"), 256).alias("payload_digest"))
    groups = settle(rows.where(f"payload_bytes >= {REVISIT_BYTES}").groupBy("payload_digest")
                    .agg(F.count("*").alias("_n"), F.min("page_id").alias("_first"))
                    .where("_n > 1").withColumnRenamed("payload_digest", "_digest"), "warc-groups")
    # a page id that is repeated with the same payload is the response each time
    return (rows.join(groups, (F.col("payload_digest") == F.col("_digest"))
                      & ~F.col("page_id").eqNullSafe(F.col("_first")), "left")
            .withColumn("refers_to", F.col("_first")).drop("_digest", "_n", "_first"))


def _clean(value):
    """A header value: line ends and other control characters would end the header."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\x00-\x1F\x7F]", " ")


def records(plan: DataFrame) -> DataFrame:
    """One WARC record per page, without the closing blank lines, in column `value`."""
    html = F.coalesce(F.col("html"), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, html))
    fields = [
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), _clean(F.col("page_id")), F.lit(">"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", _clean(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        ("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        ("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    again = [F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(
        ">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))).otherwise("")]
    head = F.concat(F.lit("WARC/1.1\r\n"), *[x for name, v in fields for x in (F.lit(f"{name}: "), v, F.lit("\r\n"))],
                    *again, F.lit("\r\n"))
    return plan.select(F.concat(head, block).alias("value"))


def _member(record: bytes) -> bytes:
    """A gzip member without its last byte, a zero."""
    packed = gzip.compress(record, 6, mtime=0)
    if packed[-1]:  # the high byte of a length above 16 MB; an empty member ends in a zero
        packed += gzip.compress(b"", 6, mtime=0)
    return packed[:-1]


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [_member(x.as_py() + END.encode()) for x in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["value"])


def write_archives(pages: DataFrame, path: str, per_archive: int = ARCHIVE_RECORDS) -> None:
    """Write every page to gzip archives in the folder `path`; an empty table gives no record."""
    packed = records(revisit_plan(pages)).select(F.col("value").cast("binary")).mapInArrow(_members, "value binary")
    # the cast keeps the bytes, and the writer writes them unchanged
    (packed.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("compression", "none")
     .option("maxRecordsPerFile", per_archive).text(path))


def _inflate(data: bytes) -> Iterator[tuple[int, int, bytes, bool]]:
    """(start, end, content, sound) of the gzip members; damaged ones give what could be read before."""
    at = 0
    while at < len(data):
        start = data.find(MEMBER, at)
        if start < 0:
            yield at, len(data), b"", False
            return
        if start > at:
            yield at, start, b"", False
        engine, parts, pos, step, sound = zlib.decompressobj(31), [], start, STEP, False
        while pos < len(data) and not engine.eof and step:
            before = engine.copy()
            try:
                parts.append(engine.decompress(data[pos:pos + step]))
                pos += step
            except zlib.error:
                # again from before the step in smaller ones, to keep all that precedes the damaged byte
                engine, step = before, step // 2
        if step:
            sound = engine.eof
            pos = min(pos, len(data)) - len(engine.unused_data)
        else:
            pos = data.find(MEMBER, start + 1)
            pos = len(data) if pos < 0 else pos
        yield start, pos, b"".join(parts), sound
        at = max(pos, start + 1)


def _record(data: bytes, at: int):
    """(headers, block, end) of a sound record at `at`, or None."""
    if not VERSION.match(data, at):
        return None
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        return None
    headers = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = headers.get("content-length", "")
    if not size.isascii() or not size.isdigit():
        return None
    end = stop + 4 + int(size)
    if data[end:end + 4] != b"\r\n\r\n":
        return None
    block = data[stop + 4:end]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha256:") and hashlib.sha256(block).hexdigest() != digest[7:]:
        return None
    return headers, block, end + 4


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict, bytes]]:
    """("record" or "gap", first byte, end, headers, block) of one archive, compressed or not.

    Offsets of records in a compressed archive count its inflated member; those of a gap between members
    count the file.
    """
    packed = data[:2] == MEMBER[:2] or (MEMBER in data and not VERSION.search(data))
    for start, end, content, sound in (_inflate(data) if packed else [(0, len(data), data, True)]):
        if packed and not sound:
            yield "gap", start, end, {}, b""
        at, bad = 0, None
        while at < len(content):
            found = _record(content, at)
            if found:
                if bad is not None:
                    yield "gap", bad, at, {}, b""
                    bad = None
                yield "record", at, found[2], found[0], found[1]
                at = found[2]
                continue
            bad = at if bad is None else bad
            following = VERSION.search(content, at + 1)
            at = following.start() if following else len(content)
        if bad is not None:
            yield "gap", bad, len(content), {}, b""


SCHEMA = ("archive string, kind string, first long, stop long, page_id long, url string, record_type string, "
          "refers_to long, payload_bytes long, payload_digest string, payload string")


def _page(urn: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn)
    return int(m[1]) if m else None


def _row(path, kind, first, stop, headers, block):
    if kind == "gap":
        return (path, "gap", first, stop, *[None] * 7)
    payload = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
    revisit = headers.get("warc-type") == "revisit"
    told, size = headers.get("warc-payload-digest", ""), headers.get("warc-payload-length", "")
    digest = told.removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest()
    if not revisit and told.startswith("sha256:") and told[7:] != digest:
        return (path, "gap", first, stop, *[None] * 7)
    return (path, "record", first, stop, _page(headers.get("warc-record-id", "")), headers.get("warc-target-uri"),
            headers.get("warc-type"), _page(headers.get("warc-refers-to", "")),
            int(size) if revisit and size.isdigit() else len(payload), digest, payload.decode("utf-8", "replace"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every sound record (kind record) and every quarantined byte range (kind gap) of the archives in `path`.

    One archive is held in memory at a time; write_archives bounds its size.
    """
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    schema = pa.schema([(x.split()[0], pa.int64() if x.endswith("long") else pa.string()) for x in SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows, held = [], 0
                for found in salvage(data):
                    rows.append(_row(archive, *found))
                    held += len(found[4])
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, SCHEMA)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write `pages` under the shared checkpoint folder and read the archives back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write_archives(pages, path)
    return read_archives(spark, path)
