"""WARC archives: written by Spark, read back and assembled by transaction.

Each page becomes three records of one transaction: a request, a response (or
a revisit, where an earlier page has the same payload) and a metadata record.
Request and metadata name their response in ``WARC-Concurrent-To``.  Reading
parses records one by one by ``Content-Length`` and joins them again through
these identifiers: one nested row per capture.  A revisit finds its payload
through ``WARC-Refers-To``.

Archives are Spark's text output with the record's end, two line ends, as line
separator, gzipped, with a bounded number of records per file; so they go to
any store Spark writes to, and a lost task leaves no half archive.

Defined results: a null html is an empty payload, which has a response like
any other; a null page id is a response only if no page with an id has its
payload, and never referred to by id; pages that share id and payload are all
responses or all revisits, one row each; a null url is an empty target; line
ends in a url are percent-encoded.  An empty table gives an empty result.
Pages are read by the three columns named, others may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

RECORDS_PER_FILE = 6000  # three to a page
CAPTURED_AT = "2026-01-01T00:00:00Z"
END = "\r\n\r\n"
# --- fixed values ------------------------------------------------------------
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# -----------------------------------------------------------------------------
RECORD = ("record_id string, type string, concurrent_to string, refers_to string, uri string, date string, "
          "payload_digest string, http string, payload binary, payload_bytes long, fields map<string,string>")


def base32_sha1(sha1_hex: Column) -> Column:
    """40 hex digits as 32 base-32 digits, five at a time."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), HEX_DIGITS, BASE32_DIGITS)


def _urn(kind: str, page_id: Column, url: Column, sha: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(page_id.cast("string"), F.lit("")), url, sha))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str, headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {CAPTURED_AT}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` as gzipped WARC files under ``path``.  Payloads of at
    least ``min_bytes`` that repeat are revisits of the smallest page id."""
    target = F.replace(F.replace(F.coalesce(F.col(f"`{url}`"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col(f"`{page_id}`").alias("page"), target.alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("body"))
    rows = rows.withColumn("sha", F.sha1("body"))
    first = F.min(F.struct(F.col("page").isNull().alias("unnamed"), "page", "url")).alias("first")
    repeats = rows.where(F.octet_length("body") >= min_bytes).groupBy("sha").agg(first, F.count("*").alias("n"))
    # Stored, so that Spark knows its size and joins accordingly.
    repeats = materialize(repeats.where("n > 1").select("sha", "first.page", "first.url").toDF("sha", "first_page", "first_url"), "warc-repeats")
    rows = rows.join(repeats.withColumn("repeated", F.lit(True)), "sha", "left")
    revisit = F.col("repeated").isNotNull() & (F.octet_length("body") >= min_bytes) & ~F.col("page").eqNullSafe(F.col("first_page"))

    page, to, sha = F.col("page"), F.col("url"), F.col("sha")
    own = _urn("response", page, to, sha)
    digest = F.concat(F.lit("sha1:"), base32_sha1(sha))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("body").cast("string"), F.lit(END))
    uri, kind = ("WARC-Target-URI", to), F.lit("application/http; msgtype=response")
    host = F.regexp_extract(to, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    request = F.concat(F.lit("GET "), F.regexp_replace(to, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""),
                       F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))
    fields = F.concat(F.when(page.isNotNull(), F.concat(F.lit("page-id: "), page.cast("string"), F.lit("\r\n"))).otherwise(F.lit("")),
                      F.lit("payload-length: "), F.octet_length("body").cast("string"), F.lit("\r\n"))
    response = _record("response", [("WARC-Record-ID", own), uri, ("WARC-Payload-Digest", digest), ("Content-Type", kind)],
                       F.concat(http, F.col("body")))
    again = _record("revisit", [("WARC-Record-ID", own), uri, ("WARC-Payload-Digest", digest), ("Content-Type", kind),
                                ("WARC-Profile", F.lit(REVISIT_PROFILE)),
                                ("WARC-Refers-To", _urn("response", F.col("first_page"), F.col("first_url"), sha))], http)
    asked = _record("request", [("WARC-Record-ID", _urn("request", page, to, sha)), uri, ("WARC-Concurrent-To", own),
                                ("Content-Type", F.lit("application/http; msgtype=request"))], request)
    about = _record("metadata", [("WARC-Record-ID", _urn("metadata", page, to, sha)), uri, ("WARC-Concurrent-To", own),
                                 ("Content-Type", F.lit("application/warc-fields"))], fields)
    records = rows.select(F.explode(F.array(asked, F.when(revisit, again).otherwise(response), about)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse_archive(raw: bytes) -> Iterator[dict]:
    """The records of one archive, gzipped (in any number of members) or not."""
    while raw[:2] == b"\x1f\x8b":
        parts, rest = [], raw
        while rest:
            member = zlib.decompressobj(31)
            parts.append(member.decompress(rest))
            rest = member.unused_data
        raw = b"".join(parts)
    at = 0
    while (stop := raw.find(b"\r\n\r\n", at)) >= 0:
        head = dict(x.split(": ", 1) for x in raw[at:stop].decode().split("\r\n")[1:])
        block = raw[stop + 4:stop + 4 + int(head["Content-Length"])]
        at = stop + 4 + len(block) + 4
        out = {"record_id": head["WARC-Record-ID"], "type": head["WARC-Type"], "concurrent_to": head.get("WARC-Concurrent-To"),
               "refers_to": head.get("WARC-Refers-To"), "uri": head.get("WARC-Target-URI"), "date": head["WARC-Date"],
               "payload_digest": head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
               "http": None, "payload": None, "payload_bytes": None, "fields": None}
        if out["type"] == "metadata":
            out["fields"] = [tuple(x.split(": ", 1)) for x in block.decode().split("\r\n") if x]
        else:
            http, _, payload = block.partition(b"\r\n\r\n")
            out["http"] = http.decode()
            if out["type"] == "response":
                out["payload"], out["payload_bytes"] = payload, len(payload)
                found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if out["payload_digest"] not in (None, found):
                    raise ValueError(f"damaged record {out['record_id']}")
                out["payload_digest"] = found
        yield out


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives under ``path``; without ``payloads`` only
    their length and digest."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(spark.createDataFrame([], RECORD).schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for r in parse_archive(batch.column("content")[i].as_py()):
                    rows.append(r if payloads else {**r, "payload": None})
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, uri, date, type, refers_to,
    response, request, metadata``.  Records that repeat an identifier of a
    request or metadata count once; a capture without one has a null there."""
    request = F.when(F.col("type") == "request", F.struct("record_id", "http"))
    metadata = F.when(F.col("type") == "metadata", F.struct("record_id", F.map_entries("fields").alias("fields")))
    around = records.where("type IN ('request', 'metadata')").groupBy("concurrent_to").agg(
        F.max(request).alias("request"), F.max(metadata).alias("metadata")).withColumnRenamed("concurrent_to", "capture_id")
    heads = records.where("type IN ('response', 'revisit')").select(
        F.col("record_id").alias("capture_id"), "uri", "date", "type", "refers_to",
        F.struct("http", "payload", "payload_bytes", "payload_digest").alias("response"))
    return heads.join(around, "capture_id", "left").select(
        "capture_id", "uri", "date", "type", "refers_to", "response", "request",
        F.struct("metadata.record_id", F.map_from_entries("metadata.fields").alias("fields")).alias("metadata"))


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the checkpoint folder, read them back and
    return a row per capture: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to``."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    write_archives(pages, path, page_id, url, html, min_bytes)
    found = assemble(read_records(spark, path, payloads=False)).select(
        "capture_id", "refers_to", "type", "response.payload_bytes", "response.payload_digest",
        F.element_at("metadata.fields", "page-id").cast("bigint").alias("page_id"))
    found = materialize(found, "warc-captures")
    answers = found.where("type = 'response'").groupBy("capture_id").agg(
        F.min("page_id").alias("origin"), F.max("payload_bytes").alias("origin_bytes")).withColumnRenamed("capture_id", "origin_id")
    out = found.join(answers, found["refers_to"] == answers["origin_id"], "left")
    return out.select("page_id", F.coalesce("payload_bytes", "origin_bytes").alias("payload_bytes"), "payload_digest",
                      F.col("type").alias("record_type"), F.col("origin").alias("refers_to"))
