"""WARC archives: written from pages, read back and assembled into captures (operator 4).

Each page becomes three records: a response (or a revisit of an equal payload), the request, and a metadata
record; the last two name the first in ``WARC-Concurrent-To``. Archives are plain WARC 1.1 files that Spark's own
writer puts into the shared checkpoint folder (any store that Spark reaches). An archive ends with the page that brings it to
``FILE_BYTES``, however uneven the pages are. They are read as whole files through Spark; records are found by their lengths,
and each response's digest is computed again.

Transaction assembly: records are grouped by the record they are concurrent to, partial aggregation first,
and give one nested row per capture (response, request, metadata). ``WARC-Refers-To`` names a record of the archives, and
references are resolved by joining them to record ids.

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes, those with the largest page id are responses, the others
revisit it; smaller payloads are all responses. Null pages are empty; null ids never win unless all are null; repeated rows are
captures of their own, of which a reference names one. Line breaks in a URL are left out of the headers. An empty table writes no records and gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.llm.tables import cut, small
from riskline.session import ensure_checkpoint_dir

REVISIT_BYTES = 1000
FILE_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def _record(kind: str, own_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record as text, up to the first of the two line ends after its block."""
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: "), own_id]
    for name, value in headers:
        lines += [F.lit(f"\r\n{name}: "), value]
    return F.concat(*lines, F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n"))


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` with ``winner`` (the largest page id of equal payloads, if there are several) and ``tail``, which ends the ids
    of a page's records: empty for the first of the rows of one page and payload, and a number for the others. Only rows
    that are repeated are written out for it, as their numbers must not change between two reads."""
    keys = cut(rows.groupBy("page_id", "digest", "bytes").agg(F.count("*").alias("times")))
    same = keys.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("winner"), F.sum("times").alias("n"))
    same = cut(same.filter("n > 1").select("digest", "winner"))
    again = keys.filter("times > 1").select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"))
    tail = F.lit("")
    if again.head(1):
        again = small(again)
        met = (F.col("digest") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_page"))
        copies = cut(rows.join(again, met, "left_semi").withColumn("copy", F.monotonically_increasing_id()))
        first = cut(copies.groupBy("page_id", "digest").agg(F.min("copy").alias("copy")).select(F.col("copy").alias("_copy")))
        copies = copies.join(small(first), F.col("copy") == F.col("_copy"), "left")
        copies = copies.withColumn("tail", F.when(F.col("_copy").isNotNull(), tail).otherwise(F.concat(F.lit(":"), F.col("copy").cast("string"))))
        rows = rows.join(again, met, "left_anti").withColumn("tail", tail).unionByName(copies.drop("copy", "_copy"))
    else:
        rows = rows.withColumn("tail", tail)
    return rows.join(small(same), "digest", "left")


def with_records(pages: DataFrame) -> DataFrame:
    """(value): per page the text of its three records. ``pages`` has page_id, url, html."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id"), F.translate(F.coalesce("url", F.lit("")), "\r\n", "").alias("url"), html.alias("html"))
    rows = _named(rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html")}))

    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    name = lambda of, *more: F.concat(F.lit("<urn:capture:"), of, F.lit(":"), F.col("digest"), *more, F.lit(">"))
    own = name(page, F.col("tail"))
    part = lambda what: name(page, F.col("tail"), F.lit(f":{what}"))
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    path = F.regexp_extract("url", "^[a-z]+://[^/?#]*([^#]*)", 1)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    uri = ("WARC-Target-URI", F.col("url"))
    response_type = ("Content-Type", F.lit("application/http; msgtype=response"))
    response = _record("response", own, [uri, digest, response_type], F.concat(http, F.col("html")))
    first = name(F.coalesce(F.col("winner").cast("string"), F.lit("")))
    revisit = _record("revisit", own, [uri, digest, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", first), response_type], http)
    with_it = ("WARC-Concurrent-To", own)
    get = F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n"))
    request = _record("request", part("request"), [uri, with_it, ("Content-Type", F.lit("application/http; msgtype=request"))], get)
    about = F.concat(F.lit("page-id: "), page, F.lit("\r\n"))
    metadata = _record("metadata", part("metadata"), [uri, with_it, ("Content-Type", F.lit("application/warc-fields"))], about)
    again = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    gap = F.lit("\r\n")
    return rows.select(F.concat(request, gap, F.when(again, revisit).otherwise(response), gap, metadata).alias("value"))


def write_archives(pages: DataFrame, path: str | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Writes the pages' records as WARC files and returns their folder. Each task joins records until they have
    ``file_bytes``; such a text is one row of Spark's writer, and one file."""
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for value in batch.column(0):
                text = value.as_buffer().to_pybytes()
                held.append(text)
                size += len(text)
                if size >= file_bytes:
                    yield archive(held)
                    held, size = [], 0
        if held:
            yield archive(held)

    def archive(records: list[bytes]) -> pa.RecordBatch:
        column = pa.array([b"\r\n".join(records)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([column], names=["value"])

    with_records(pages).mapInArrow(run, "value string").write.option("lineSep", "\r\n").option("maxRecordsPerFile", 1).text(path)
    return path


def records_in(content: bytes):
    """(headers, block) of each record of an archive, found by their lengths."""
    at, end = 0, len(content)
    while at < end:
        cut_at = content.find(b"\r\n\r\n", at)
        lines = content[at:cut_at].split(b"\r\n")
        if cut_at < 0 or not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        start = cut_at + 4
        stop = start + int(headers["content-length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is longer or shorter than it says")
        yield headers, memoryview(content)[start:stop]
        at = stop + 4


RECORD = "capture string, kind string, record_id string, refers_to string, url string, payload_digest string, payload_bytes long, fields string, payload binary"


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in a folder (``payloads=False`` leaves the bodies out)."""

    def run(batches):
        kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.binary()]
        names = [c.split(" ")[0] for c in RECORD.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, block in records_in(content.as_buffer().to_pybytes()):
                    kind, digest, size, fields, body = h["warc-type"], h.get("warc-payload-digest", "").removeprefix("sha1:") or None, None, None, None
                    raw = block.tobytes()
                    if kind in ("response", "revisit"):
                        head, _, body = raw.partition(b"\r\n\r\n")
                        size = int(head.lower().rpartition(b"content-length:")[2].split(b"\r\n")[0])
                        if kind == "response":
                            if hashlib.sha1(body).hexdigest() != digest or len(body) != size:
                                raise ValueError(f"payload of {h['warc-record-id']} does not match its headers")
                    else:
                        fields = raw.decode("utf-8", "replace")
                    capture = h.get("warc-concurrent-to", h["warc-record-id"])
                    own = (capture, kind, h["warc-record-id"], h.get("warc-refers-to"), h.get("warc-target-uri"), digest, size, fields)
                    rows.append((*own, body if payloads and kind == "response" else None))
                columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture, url, response, request, metadata`` joined by concurrent-to identifiers."""
    fields = ["record_id", "kind", "refers_to", "payload_digest", "payload_bytes", "fields", "payload"]
    of = lambda *kinds: F.any_value(F.when(F.col("kind").isin(*kinds), F.struct(*fields)), ignoreNulls=True)
    return records.groupBy("capture").agg(
        F.any_value("url", ignoreNulls=True).alias("url"),
        of("response", "revisit").alias("response"),
        of("request").alias("request"),
        of("metadata").alias("metadata"),
    )


def archive_digest(pages: DataFrame) -> DataFrame:
    """Pages written as archives and read back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    kind = pages.schema["page_id"].dataType
    path = write_archives(pages.select("page_id", "url", "html"))
    page = F.nullif(F.regexp_extract("metadata.fields", "(?s)page-id: (.*)\r\n", 1), F.lit("")).cast(kind)
    read = captures(read_records(pages.sparkSession, path, payloads=False))
    read = cut(read.select(page.alias("page_id"), F.col("response.*")).drop("fields", "payload"))
    wanted = read.select("refers_to").filter("refers_to is not null").distinct()
    named = read.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("_page"))
    named = cut(named.join(small(wanted), "refers_to", "left_semi"))
    return read.join(small(named), "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.col("_page").alias("refers_to")
    )


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT payload_digest, max(page_id) AS winner FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN winner IS NULL OR winner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN winner <> page_id THEN winner END AS refers_to
FROM p LEFT JOIN w ON w.payload_digest = p.payload_digest AND p.payload_bytes >= 1000
"""
