"""WARC archives: written with Spark's text writer, read back, assembled into captures.

A capture is one transaction: a request, its response (or a revisit of an
earlier payload) and a metadata record.  Request and metadata name the response
in ``WARC-Concurrent-To``.

Writing.  A record ends with two line breaks, so a text file whose line
separator is just that, one record a line, is a WARC file; executors write it
to whatever store Spark writes to.  Of the records with equal payloads of at
least ``least_bytes``, one response keeps the payload: that with the largest
page_id (of rows repeating this id, the first by url).  The others are revisit
records that refer to it and hold the HTTP header only.  Payload groups are
reduced to one row each before anything is joined to them; pages travel once,
keyed by page_id and digest, so a payload that a third of all pages share is
spread like any other.

Reading.  Files are bounded by ``RECORDS_PER_FILE``; a task streams through one
and takes each record by its Content-Length, so payloads may hold anything,
record headers too.  Digests and lengths are computed from what was read.

Assembly.  Non-response records are joined to responses through their
concurrent-to identifiers, or through a record that is itself joined (metadata
that names the request), or the other way round; captures come out as one
nested row each.  Records that reach no response are left out.

Defined cases: a null or empty page is an empty payload; a null url gives
records without target; a null page_id ranks below all others and comes back
as null; repeated rows are captures of their own; line breaks and spaces in a
url are percent-encoded.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicspark.llm.store import written
from civicspark.session import shared_path

RECORDS_PER_FILE = 15_000
LEAST_BYTES = 1_000          # of a payload that may be stored as a revisit
DATE = "2024-01-01T00:00:00Z"
EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, "
          "digest string, payload_bytes long, fields map<string,string>")
ANCHORS = ("response", "revisit")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column | str, record_id: Column, block: Column, content_type: str, *headers) -> Column:
    """Header and block; a header whose value is null is left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id),
             F.lit(f"WARC-Date: {DATE}"), *[F.concat(F.lit(f"{k}: "), v) for k, v in headers],
             F.lit(f"Content-Type: {content_type}"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(EOL, *lines), F.lit(EOL + EOL), block)


def with_roles(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages plus ``payload``, ``digest``, ``record_id``, ``refers_to`` (null: a response)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    # a key without nulls, so that the join and the numbering below share one shuffle of the pages
    page = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"),
                        F.coalesce(F.col("page_id").cast("string"), F.lit("-")).alias("page_key"))
    long = page.filter(F.octet_length("payload") >= least_bytes).select("page_id", "page_key", "digest")
    top = (long.groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
           .filter(F.col("n") > 1).drop("n"))
    # one row per page of a shared payload, small: the pages themselves travel by page and digest
    shared = (long.select("digest", "page_key").distinct().join(top, "digest")
              .select("digest", "page_key", "top", F.lit(True).alias("shared")))
    nth = F.row_number().over(Window.partitionBy("digest", "page_key").orderBy("url"))
    out = page.join(shared, ["digest", "page_key"], "left").withColumn("nth", nth)
    kept = F.col("shared").isNull() | (F.col("page_id").eqNullSafe(F.col("top")) & (F.col("nth") == 1))
    return out.select(
        "page_id", "url", "payload", "digest",
        _uuid(F.lit("response"), F.col("digest"), F.col("page_id"), F.col("nth")).alias("record_id"),
        F.when(~kept, _uuid(F.lit("response"), F.col("digest"), F.col("top"), F.lit(1))).alias("refers_to"))


def write_archive(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES,
                  records_per_file: int = RECORDS_PER_FILE) -> None:
    """Three records per page (request, response or revisit, metadata) as gzipped WARC files."""
    p = with_roles(pages, least_bytes)
    uri = F.col("url")
    for a, b in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        uri = F.replace(uri, F.lit(a), F.lit(b))
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                      F.octet_length("payload").cast("string"), F.lit(EOL + EOL))
    ask = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(f" HTTP/1.1{EOL}{EOL}"))
    rid, again = F.col("record_id"), F.col("refers_to").isNotNull()
    about = F.concat(F.lit("source: table" + EOL),
                     F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(EOL)), F.lit("")))
    records = F.array(
        _record("request", _uuid(F.lit("request"), rid), ask, "application/http; msgtype=request",
                ("WARC-Target-URI", uri), ("WARC-Concurrent-To", rid)),
        _record(F.when(again, "revisit").otherwise("response"), rid,
                F.when(again, answer).otherwise(F.concat(answer, F.col("payload"))),
                "application/http; msgtype=response", ("WARC-Target-URI", uri),
                ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                ("WARC-Refers-To", F.col("refers_to")), ("WARC-Profile", F.when(again, F.lit(PROFILE)))),
        _record("metadata", _uuid(F.lit("metadata"), rid), about, "application/warc-fields",
                ("WARC-Concurrent-To", rid)))
    (p.select(F.explode(records).alias("value")).write.option("lineSep", EOL + EOL)
     .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def _headers(raw: bytes) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for line in raw.decode("utf-8", "replace").split(EOL):
        name, _, value = line.partition(":")
        if value:
            out.setdefault(name.strip().lower(), []).append(value.strip())
    return out


def records(content: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Header and block of every record of a WARC file, plain or gzipped."""
    raw = io.BytesIO(content)
    stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    reader = io.BufferedReader(stream, 1 << 20)
    while line := reader.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should start")
        head = []
        while (line := reader.readline()).strip():
            head.append(line)
        headers = _headers(b"".join(head))
        length = int(headers["content-length"][0])
        block = reader.read(length)
        if len(block) != length:
            raise ValueError("a WARC record is cut off")
        yield headers, block


def parsed(headers: dict[str, list[str]], block: bytes) -> dict:
    first = lambda k: headers.get(k, [None])[0]
    kind = first("warc-type")
    row = {"record_id": first("warc-record-id"), "type": kind, "concurrent_to": headers.get("warc-concurrent-to", []),
           "refers_to": first("warc-refers-to"), "target_uri": first("warc-target-uri"), "digest": None,
           "payload_bytes": None, "fields": [], "payload": None}
    if kind in ANCHORS:
        head, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            row |= {"digest": hashlib.sha1(payload).hexdigest(), "payload_bytes": len(payload), "payload": payload}
        else:                # the payload lies elsewhere; the headers tell its digest and length
            told = _headers(head)
            row |= {"digest": (first("warc-payload-digest") or "").removeprefix("sha1:") or None,
                    "payload_bytes": int(told["content-length"][0]) if "content-length" in told else None}
    elif kind == "metadata":
        row["fields"] = [(k, v[0]) for k, v in _headers(block).items()]
    return row


def read_archive(spark: SparkSession, path: str, payloads: bool = True, per_batch: int = 500) -> DataFrame:
    """One row per record of all files under ``path``; ``payload`` only if asked for."""
    schema = RECORD + (", payload binary" if payloads else "")
    kinds = [("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())),
             ("refers_to", pa.string()), ("target_uri", pa.string()), ("digest", pa.string()),
             ("payload_bytes", pa.int64()), ("fields", pa.map_(pa.string(), pa.string()))]
    kinds += [("payload", pa.binary())] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for headers, block in records(content.as_py()):
                    rows.append(parsed(headers, block))
                    if len(rows) == per_batch:
                        yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in kinds], names=[k for k, _ in kinds])
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in kinds], names=[k for k, _ in kinds])
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def _key(record_id: Column) -> Column:
    """16 bytes that stand for a record id while records are joined."""
    return F.unhex(F.md5(record_id.cast("binary")))


def assemble(found: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response`` (or revisit), ``requests``, ``metadata``.
    ``fields`` names the record columns to nest (default: all)."""
    keep = fields or [c for c in found.columns if c != "concurrent_to"]
    keyed = found.select(_key(F.col("record_id")).alias("key"), F.col("type").isin(*ANCHORS).alias("anchor"),
                         F.transform("concurrent_to", _key).alias("others"), F.struct(*dict.fromkeys(["type", *keep])).alias("record"))
    link = keyed.select("key", F.explode("others").alias("other"))
    # both directions, so it does not matter which record names which
    link = link.unionByName(link.select(F.col("other").alias("key"), F.col("key").alias("other"))).distinct()
    anchors = keyed.filter("anchor").select(F.col("key").alias("other"))
    beside = link.join(anchors.select(F.col("other").alias("key")), "key", "left_anti")
    direct = beside.join(anchors, "other").select("key", F.col("other").alias("capture"))
    through = (beside.join(direct.select("key"), "key", "left_anti")
               .join(direct.select(F.col("key").alias("other"), "capture"), "other").select("key", "capture"))
    member = direct.unionByName(through).distinct()
    kind = F.col("record.type")
    nested = F.struct(*[F.col(f"record.{c}").alias(c) for c in keep])
    parts = (keyed.filter(~F.col("anchor")).select("key", "record").join(member, "key")
             .groupBy("capture").agg(F.collect_list(F.when(kind == "request", nested)).alias("requests"),
                                     F.collect_list(F.when(kind == "metadata", nested)).alias("metadata")))
    return (keyed.filter("anchor").select(F.col("key").alias("capture"), nested.alias("response"))
            .join(parts, "capture", "left").withColumnRenamed("capture", "capture_id"))


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages to archives and back: one digest row per capture."""
    spark = pages.sparkSession
    path = shared_path(spark, "llm-warc")
    write_archive(pages, path, least_bytes)
    found = written(read_archive(spark, path, payloads=False), "records")
    captures = assemble(found, ["payload_bytes", "digest", "refers_to", "fields", "type"])
    page_id = F.get("metadata", F.lit(0))["fields"]["page-id"].cast("long")
    flat = written(captures.select(
        "capture_id", page_id.alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        _key(F.col("response.refers_to")).alias("target")), "captures")
    first = flat.filter(F.col("record_type") == "response").select(
        F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to"))
    return flat.join(first, "target", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
