"""WARC archives: writing captures as request, response or revisit, and metadata records, and assembling them again.

Records of one capture name each other by WARC-Concurrent-To. A response whose
payload another response already holds is written as a revisit that refers to it.
Reading parses records by Content-Length and joins them by their identifiers
into one nested row per capture.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldcast.llm.common import scratch, scratch_path

DATE = "1970-01-01T00:00:00Z"       # archives are made from tables without capture times
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 6_000
_CRLF = "\r\n"

RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
          "declared_digest string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 20 bits, five hex digits, are four base32 digits."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _id(kind: str) -> Column:
    h = F.md5(F.concat(F.lit(kind + "/"), F.col("capture")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """Text of one record. The two line ends that close it are added by the writer. Null headers are left out."""
    lines = [F.lit("WARC/1.1")]
    for name, value in [*headers, ("Content-Length", F.octet_length(block).cast("string"))]:
        lines.append(F.concat(F.lit(name + ": "), value))
    return F.concat(F.concat_ws(_CRLF, *lines), F.lit(_CRLF * 2), block)


def capture_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                    least_bytes: int = 0) -> DataFrame:
    """Three record texts per page: request, response or revisit, metadata.

    Of pages with equal payloads of at least ``least_bytes`` bytes, that with the largest key is the response (a null key is smaller
    than any; among equal keys one of them is) and the others revisit it. It is found from keys and digests alone.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    base = pages.select(F.col(key).cast("string").alias("key"), F.col(key).alias("rank"),
                        F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), "[\\x00-\\x20\\x7f]", "%20").alias("url"),
                        payload.alias("payload"), F.monotonically_increasing_id().alias("line"))
    base = base.withColumn("digest", base32_sha1(F.col("payload").cast("binary"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    first = (base.where(F.col("bytes") >= least_bytes)
             .groupBy("digest", "bytes").agg(F.max(F.struct("rank", "line")).alias("top")).select("digest", "bytes", F.col("top.line").alias("top")))
    keys = base.select("digest", "bytes", "line")
    owner = keys.join(first, ["digest", "bytes"]).where("line != top").select(F.col("line"), F.col("top"))
    rows = base.join(owner, "line", "left").withColumn("capture", F.col("line").cast("string"))

    host = F.coalesce(F.nullif(F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")), F.lit("unknown"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(_CRLF * 2))
    is_copy = F.col("top").isNotNull()
    uri, date = ("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(DATE))
    mine = _id("response")
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _id("request")), date, uri, ("WARC-Concurrent-To", mine),
         ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(_CRLF * 2)))
    original = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[
        F.substring(F.md5(F.concat(F.lit("response/"), F.col("top").cast("string"))), a, n)
        for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))
    response = _record(
        [("WARC-Type", F.when(is_copy, "revisit").otherwise("response")), ("WARC-Record-ID", mine), date, uri,
         ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
         ("WARC-Profile", F.when(is_copy, PROFILE)), ("WARC-Refers-To", F.when(is_copy, original)),
         ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.when(is_copy, head).otherwise(F.concat(head, F.col("payload"))))
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _id("metadata")), date, uri, ("WARC-Concurrent-To", mine),
         ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("key"), F.lit(_CRLF)), F.lit("")), F.lit("via: table\r\n")))
    return rows.select(F.explode(F.array(request, response, metadata)).alias("value"))


def write_archives(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> str:
    """Write record texts as gzip-compressed WARC files (named by Spark, part-*.txt.gz); two line ends close each record."""
    (records.write.option("lineSep", _CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).mode("errorifexists").text(path))
    return path


def parse_records(data: bytes):
    """Records of an uncompressed archive as (headers, block); a header's name is lower-cased, the last of equal names counts."""
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode("utf-8").split(_CRLF)
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in head[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        start = end + 4
        at = start + int(fields["content-length"])
        if at > len(data):
            raise ValueError("archive ends inside a record")
        yield fields, data[start:at]


def _read_task(batches: Iterator, with_payload: bool) -> Iterator:
    import base64
    import gzip
    import hashlib

    import pyarrow as pa

    types = [pa.string()] * 7 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [f.split(" ")[0] for f in RECORD.split(", ")]

    def rows(data):
        for fields, block in parse_records(data):
            kind, size, digest, payload, more = fields["warc-type"], None, None, None, {}
            if kind in ("request", "response", "revisit"):
                head, _, body = block.partition(b"\r\n\r\n")
                lines = head.decode("utf-8").split(_CRLF)
                more = {"status-line": lines[0]} | {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:])}
                if kind == "response":
                    size, payload = len(body), body
                    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
                elif kind == "revisit":
                    size = int(more.get("content-length", 0))
            else:
                more = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in block.decode("utf-8").split(_CRLF) if x)}
            declared = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
            if digest and declared and digest != declared:
                raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
            yield (fields["warc-record-id"], kind, fields.get("warc-concurrent-to"), fields.get("warc-refers-to"),
                   fields.get("warc-target-uri"), declared, digest or declared, size, list(more.items()), payload if with_payload else None)

    for batch in batches:
        for cell in batch.column(0):
            held, weight = [], 0
            for row in rows(gzip.decompress(cell.as_py())):
                held.append(row)
                weight += 400 + len(row[-1] or b"")
                if weight > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                    held, weight = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives under ``path``; a response's payload is held against its digest (a mismatch raises)."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(partial(_read_task, with_payload=with_payload), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its request and metadata, joined by concurrent-to.

    Each capture has exactly one response or revisit record; a missing request or metadata record leaves that struct null.
    Records that are concurrent to an unknown record belong to no capture. ``original`` is the metadata of the response that
    a revisit refers to, null for a response. Joins are on record identifiers; a response that very many
    revisits refer to is a skewed key of a plain join, which Spark splits.
    """
    beside = records.where("type in ('request', 'metadata') and concurrent_to is not null").select(
        "concurrent_to", "type", F.struct("record_id", "target_uri", F.to_json("fields").alias("fields")).alias("record"))
    sides = beside.groupBy("concurrent_to").agg(
        F.max(F.when(F.col("type") == "request", F.col("record"))).alias("request"),
        F.max(F.when(F.col("type") == "metadata", F.col("record"))).alias("metadata"))
    main = records.where("type in ('response', 'revisit')").select(
        "record_id", "refers_to", F.struct("record_id", "type", "target_uri", "payload_digest", "payload_bytes", "refers_to",
                                           "fields", "payload").alias("response"))
    captures = main.join(sides, main["record_id"] == sides["concurrent_to"], "left").drop("concurrent_to")
    origin = sides.select("concurrent_to", F.col("metadata").alias("original"))
    return (captures.join(origin, captures["refers_to"] == origin["concurrent_to"], "left")
            .select("response", "request", "metadata", "original"))


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write the pages' captures under the shared checkpoint folder, read the archives back, and report each page.

    Per row: page_id, payload_bytes, payload_digest, record_type, refers_to. A null html is an empty payload, a null url an empty
    target; repeated rows are captures of their own, all but one of which revisit. An empty table gives an empty result. Columns other than the three named are not read.
    """
    spark = pages.sparkSession
    kind = dict(pages.dtypes)[key]
    path = write_archives(capture_records(pages, key, url, html, least_bytes), scratch_path(spark, "warc"))
    captures = assemble(scratch(read_records(spark, path, with_payload=False)))

    def page(column):
        return F.from_json(F.col(column)["fields"], "map<string,string>")["page-id"].cast(kind)

    return captures.select(page("metadata").alias(key), F.col("response.payload_bytes").alias("payload_bytes"),
                           F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
                           page("original").alias("refers_to"))
