"""WARC archives: captures are written as request, response and metadata records and assembled again when read.

``write_archives`` turns pages into WARC 1.1 records and writes gzip archives with Spark's text writer, whose line
separator is the end of a WARC record. ``read_records`` reads archives as binary files, each parsed in one task by
Content-Length, and ``assemble`` joins the records of a transaction through WARC-Concurrent-To into one nested row
per capture. Records of one transaction may lie in different archives.

Payloads of ``MIN_REVISIT_BYTES`` or more that are equal are stored once: the capture with the largest key is the
response, the others become revisit records, which keep the HTTP header and the payload's digest and refer to the
response. Smaller payloads are always responses.

Defined results: a null payload is an empty one, a null target is an empty URI; a page without a key is always a
response; pages that repeat the largest key of a payload are responses each, so nothing refers to itself; captures
that repeat a key are numbered and come back one row each. An empty table gives an archive without records and an
empty result. Extra columns are not read.

Archives hold ``records_per_file`` captures at most, so one task reads a bounded share. The payload digests are
joined by page key, not by digest, so a payload that a third of all pages share does not meet in one task.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import common

MIN_REVISIT_BYTES = 1000
CAPTURES_PER_FILE = 4000

CRLF = "\r\n"
RECORD_END = CRLF * 2
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = ("record_id string, concurrent_to string, refers_to string, record_type string, target_uri string, "
                 "block string, payload_bytes bigint, payload_digest string, payload binary")


def pages_as_captures(pages: DataFrame, key: str = "page_id", uri: str = "url", body: str = "html") -> DataFrame:
    """(capture, key, uri, payload, n_bytes, digest, refers_to): every page with its digest and, for a revisit, the
    key of its response."""
    payload = F.coalesce(F.col(body).cast("string"), F.lit(""))
    wide = pages.select(F.col(key).cast("long").alias("key"),
                        F.coalesce(F.col(uri).cast("string"), F.lit("")).alias("uri"), payload.alias("payload"))
    narrow = wide.select("key", F.octet_length("payload").alias("n_bytes"),
                         F.sha1(F.col("payload").cast("binary")).alias("digest"))
    # only digests that occur again need a join; both sides are aggregated before they are shuffled
    shared = narrow.where((F.col("n_bytes") >= MIN_REVISIT_BYTES) & F.col("key").isNotNull()).groupBy(
        "digest", "n_bytes").agg(F.max("key").alias("first"), F.min("key").alias("least"))
    shared = shared.where("first <> least").select("digest", "n_bytes", "first")
    revisits = narrow.join(shared, ["digest", "n_bytes"]).where("key <> first").select(
        F.col("key").alias("r_key"), F.col("first").alias("refers_to"), F.col("digest").alias("r_digest")).distinct()
    body_digest = F.sha1(F.col("payload").cast("binary"))
    full = wide.withColumn("n_bytes", F.octet_length("payload").cast("long")).withColumn("digest", body_digest)
    return full.join(revisits, (full["key"] == revisits["r_key"]) & (full["digest"] == revisits["r_digest"]),
                     "left").drop("r_key", "r_digest")


def _header(kind: str, *fields) -> F.Column:
    """A WARC header: the fields are (name, column or text, condition or None)."""
    lines = [F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}" if kind else "")]
    for name, value in fields:
        lines.append(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)))
    return F.concat(*lines)


def capture_records(captures: DataFrame, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """(record): the request, response or revisit, and metadata record of every capture as text, without its end."""
    text = lambda c: F.col(c).cast("string")
    numbered = captures.withColumn("capture", F.concat(
        F.coalesce(text("key"), F.lit("none")), F.lit("-"), F.monotonically_increasing_id().cast("string")))
    urn = lambda kind, name=F.col("capture"): F.concat(F.lit(f"<urn:{kind}:"), name, F.lit(">"))
    is_revisit = F.col("refers_to").isNotNull()
    uri = F.regexp_replace("uri", r"[\r\n]", " ")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    text("n_bytes"), F.lit(CRLF * 2))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    date_line, id_line = ("WARC-Date", F.lit(date)), lambda kind: ("WARC-Record-ID", urn(kind))
    length = lambda c: ("Content-Length", F.octet_length(c).cast("string"))
    optional = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))
    response = F.concat(
        F.concat(F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"), F.lit(CRLF)),
        _header("", id_line("capture"), date_line, ("WARC-Target-URI", uri),
                ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))),
        optional("WARC-Refers-To", urn("page", text("refers_to"))),
        F.when(is_revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}")).otherwise(""),
        _header("", ("Content-Type", F.lit("application/http;msgtype=response")), length(block)), F.lit(CRLF), block)
    path = F.coalesce(F.nullif(F.regexp_replace(uri, r"^[a-z]+://[^/]*", ""), F.lit("")), F.lit("/"))
    host = F.regexp_extract(uri, r"^[a-z]+://([^/]*)", 1)
    get = F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF * 2))
    linked = ("WARC-Concurrent-To", urn("capture"))
    request = F.concat(_header("request", id_line("request"), date_line, ("WARC-Target-URI", uri), linked,
                               ("Content-Type", F.lit("application/http;msgtype=request")), length(get)),
                       F.lit(CRLF), get)
    note = F.concat(F.lit("pageId: "), F.coalesce(text("key"), F.lit("")), F.lit(CRLF))
    metadata = F.concat(_header("metadata", id_line("metadata"), date_line, linked,
                                ("Content-Type", F.lit("application/warc-fields")), length(note)), F.lit(CRLF), note)
    return numbered.select(F.explode(F.array(request, response, metadata)).alias("record"))


def write_archives(pages: DataFrame, path: str, captures_per_file: int = CAPTURES_PER_FILE, **columns: str) -> None:
    """Write ``pages`` as gzip WARC archives into the folder ``path``, three records a capture."""
    records = capture_records(pages_as_captures(pages, **columns))
    (records.write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", 3 * captures_per_file).text(path))


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive, plain or gzip. Raises ValueError where the bytes are no WARC record."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record begins here: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            if m := _FIELD.fullmatch(line):
                head[m[1].lower().decode()] = m[2].decode("utf-8", "replace")
        block = stream.read(int(head["content-length"]))
        yield record_row(head, block)


def record_row(head: dict[str, str], block: bytes) -> dict:
    kind = head["warc-type"]
    row = {"record_id": head["warc-record-id"], "concurrent_to": head.get("warc-concurrent-to"),
           "refers_to": head.get("warc-refers-to"), "record_type": kind, "target_uri": head.get("warc-target-uri"),
           "block": None, "payload_bytes": None, "payload_digest": None, "payload": None}
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        row["block"] = http.decode("utf-8", "replace")
        if kind == "response":
            row |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}
        else:  # the payload itself is elsewhere; its header and digest stay
            size = re.search(rb"(?i)\r\ncontent-length:[ ]*([0-9]+)", http)
            row |= {"payload_bytes": int(size[1]) if size else None,
                    "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:")}
    else:
        row["block"] = block.decode("utf-8", "replace")
    return row


def read_records(spark: SparkSession, path: str, with_payload: bool = True, batch: int = 500) -> DataFrame:
    """One row per record of the archives in ``path``. Without payloads, only their sizes and digests are kept."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*part-*").load(path).select("content")
    schema = files.select(F.lit(None)).sparkSession.createDataFrame([], RECORD_SCHEMA).schema
    names = schema.names

    def parse(batches):
        for b in batches:
            for data in b.column(0):
                rows: list[dict] = []
                for row in parse_archive(data.as_py()):
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    if len(rows) == batch:
                        yield _arrow(rows, names)
                        rows = []
                yield _arrow(rows, names)

    return files.mapInArrow(parse, schema)


def _arrow(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit with the request and metadata that name it as
    concurrent. A record without partners keeps null in their place."""
    capture = F.coalesce("concurrent_to", "record_id").alias("capture")
    part = lambda kind, *fields: F.max(F.when(F.col("record_type").isin(*kind), F.struct(*fields)))
    return records.groupBy(capture).agg(
        part(("response", "revisit"), "record_type", "target_uri", "block", "refers_to", "payload_bytes",
             "payload_digest", "payload").alias("response"),
        part(("request",), "record_id", "target_uri", "block").alias("request"),
        part(("metadata",), "record_id", "block").alias("metadata"))


def page_key(metadata_block: F.Column) -> F.Column:
    """The page key that a metadata record notes."""
    return F.nullif(F.regexp_extract(metadata_block, r"pageId: (-?[0-9]*)", 1), F.lit("")).cast("long")


def referred_page(refers_to: F.Column) -> F.Column:
    return F.nullif(F.regexp_extract(refers_to, r"^<urn:page:(-?[0-9]+)>$", 1), F.lit("")).cast("long")


def round_trip(pages: DataFrame, path: str, **columns: str) -> DataFrame:
    """Write ``pages`` to archives in ``path``, read them back and assemble: one row per capture without payloads."""
    write_archives(pages, path, **columns)
    captures = assemble(read_records(pages.sparkSession, path, with_payload=False))
    return captures.select(page_key(F.col("metadata.block")).alias("page"), "response.*").drop("payload", "block").withColumn(
        "refers_to", referred_page(F.col("refers_to")))


def archive_dir(spark: SparkSession) -> str:
    return common.shared_dir(spark, "warc")
