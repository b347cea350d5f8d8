"""WARC archives: writing captures, reading records, assembling transactions.

A capture is a request, a response or revisit, and a metadata record. Request
and metadata name the response by WARC-Concurrent-To, and reading joins the
three through that identifier into one nested row. Of captures with equal
payloads one is stored as response; the others are revisit records, which hold
the response's headers and its identifier instead of the payload.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.llm.common import salted, written

VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: 160 bits are eight groups of 20 bits, four characters each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def _urn(*parts: Column) -> Column:
    """A record identifier that is always the same for the same parts."""
    h = F.md5(F.concat_ws("\0", *(F.concat(F.when(p.isNull(), "-").otherwise("+"), F.coalesce(p, F.lit(""))) for p in parts)))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in cuts)), F.lit(">"))


def _one_line(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record(kind: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """Headers whose value is null are left out. The writer adds the last line end."""
    lines = [F.concat(F.lit("WARC-Type: "), kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.lit(f"{VERSION}\r\n"), F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block, F.lit("\r\n"))


def write_archive(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
    date: str = "2024-01-01T00:00:00Z", revisit_from: int = 0,
) -> None:
    """Write a capture for each row, as gzip-compressed WARC files, one for each task.

    The payload is ``html`` in UTF-8; null is empty. Of the rows with equal
    payloads of at least ``revisit_from`` bytes the one with the largest key is
    the response (a null key is smaller than any) and the others revisit it.
    Smaller payloads are always responses. Rows that are equal in key, URL and
    payload have equal identifiers and are read back as one capture. Rows of
    one key that differ in URL or payload are captures of their own; if they
    share the payload, the largest URL is the response. A null URL is left out
    of the headers. Other columns are left out.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("_key"),
        F.col(url).cast("string").alias("_url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("_html"),
    ).withColumn("_digest", base32_sha1(F.col("_html")))
    rows = rows.withColumn("_id", _urn(F.lit("capture"), F.col("_key").cast("string"), F.col("_url"), F.col("_digest")))
    # digests that more than one capture has; the partial maximum leaves one row of a digest in each task
    first = (
        rows.where(F.octet_length("_html") >= revisit_from)
        .select("_digest", "_key", "_url", "_id")
        .groupBy("_digest")
        .agg(
            F.max(F.struct("_key", "_url", "_id")).alias("_last"),
            F.min("_id").alias("_a"),
            F.max("_id").alias("_b"),
        )
        .where(F.col("_a") != F.col("_b"))
        .select("_digest", F.col("_last._id").alias("_original"))
    )
    met = salted(rows, first, "_digest", F.col("_id"))
    revisit = F.col("_original").isNotNull() & (F.col("_original") != F.col("_id"))
    host = F.regexp_extract(F.coalesce("_url", F.lit("")), r"(?s)://([^/?#]*)", 1)
    target = ("WARC-Target-URI", _one_line(F.col("_url")))
    when = ("WARC-Date", F.lit(date))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest")))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("_html").cast("string"),
        F.lit("\r\n\r\n"),
    )
    capture = _record(
        F.when(revisit, "revisit").otherwise("response"),
        [
            ("WARC-Record-ID", F.col("_id")), when, target, digest,
            ("WARC-Refers-To", F.when(revisit, F.col("_original"))),
            ("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("_html"))),
    )
    request = _record(
        F.lit("request"),
        [
            ("WARC-Record-ID", _urn(F.lit("request"), F.col("_id"))), when, target,
            ("WARC-Concurrent-To", F.col("_id")),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), F.coalesce(_one_line(F.col("_url")), F.lit("*")), F.lit(" HTTP/1.1\r\nHost: "), _one_line(host), F.lit("\r\n\r\n")),
    )
    metadata = _record(
        F.lit("metadata"),
        [
            ("WARC-Record-ID", _urn(F.lit("metadata"), F.col("_id"))), when, target,
            ("WARC-Concurrent-To", F.col("_id")),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(F.lit("capture-key: "), F.coalesce(F.col("_key").cast("string"), F.lit("")), F.lit("\r\n")),
    )
    met.select(F.explode(F.array(request, capture, metadata)).alias("value")).write.option("compression", "gzip").option(
        "lineSep", "\r\n"
    ).text(path)


RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("concurrent_to", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("head", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _unpacked(content: bytes) -> bytes:
    """A file may be plain, or gzip with one member or one for each record."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines.split(b"\r\n"))
    return {name.strip().lower().decode("latin-1"): value.strip().decode("utf-8", "replace") for name, _, value in pairs}


def _parse(content: bytes, with_payload: bool) -> Iterator[tuple]:
    at = content.find(b"WARC/")
    while 0 <= at < len(content):
        end = content.index(b"\r\n\r\n", at)
        fields = _fields(content[at:end])
        start = end + 4
        stop = start + int(fields["content-length"])
        block, kind = content[start:stop], fields.get("warc-type")
        head, payload = "", block
        if "application/http" in fields.get("content-type", ""):
            top, _, payload = block.partition(b"\r\n\r\n")
            head = top.decode("utf-8", "replace")
        size = len(payload)
        if kind == "revisit":  # the payload lies elsewhere; its length is that of the response's headers
            size = int(_fields(head.encode()).get("content-length", size))
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        else:
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        keep = payload if with_payload or kind == "metadata" else None
        yield (
            fields.get("warc-record-id"), kind, fields.get("warc-date"), fields.get("warc-target-uri"),
            fields.get("warc-concurrent-to"), fields.get("warc-refers-to"), head, size, digest, keep,
        )
        at = stop
        while content[at : at + 1] in (b"\r", b"\n"):
            at += 1


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row for each record of the archives at ``path``; digests are of the payloads as read.

    A file is read by one task, so archives should be cut into files that fit
    in a task's memory. Without ``with_payload`` only metadata keep theirs.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for row in _parse(_unpacked(content.as_py()), with_payload):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > 4_000_000:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(records, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], RECORDS.fieldNames())


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: key, record_id, type, response, request, metadata, refers_to, refers_to_key.

    Every response and revisit record gives one row; records that repeat an
    identifier count once. Its request and metadata are those whose
    concurrent_to names it (of several, the one with the least identifier), or
    null. Records whose concurrent_to names nothing are left out. ``key`` is
    the metadata's capture-key, null if empty or missing. ``refers_to_key`` is
    the key of the response that a revisit names.
    """
    once = records.where(F.col("record_id").isNotNull())
    main = once.where(F.col("type").isin("response", "revisit")).dropDuplicates(["record_id"])

    def side(kind: str) -> DataFrame:
        whole = F.struct("record_id", "date", "target_uri", "head", "payload")
        return (
            once.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
            .groupBy(F.col("concurrent_to").alias("record_id"))
            .agg(F.min(whole).alias(kind))
        )

    text = F.col("metadata.payload").cast("string")
    key = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?m)^capture-key: *(-?\d+)", 1)
    joined = (
        main.join(side("request"), "record_id", "left")
        .join(side("metadata"), "record_id", "left")
        .withColumn("key", F.when(key != "", key.cast("long")))
    )
    keys = joined.where(F.col("type") == "response").select(
        F.col("record_id").alias("refers_to"), F.col("key").alias("refers_to_key")
    )
    return salted(joined, keys, "refers_to", F.col("record_id")).select(
        "key",
        "record_id",
        "type",
        F.struct("date", "target_uri", "head", "payload_bytes", "payload_digest", "payload").alias("response"),
        "request",
        "metadata",
        "refers_to",
        "refers_to_key",
    )


def captures(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Read archives and assemble their captures; records are parsed once."""
    return assemble(written(read_records(spark, path, with_payload), "warc-records"))
