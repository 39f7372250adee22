"""WARC archives: written and read by Spark, with segments reassembled.

Writing: each page is a response whose block is an HTTP message in chunked transfer framing, or, where
another page has the same payload, a revisit that refers to that one. A block of more than SEGMENT bytes
is cut: the first segment is the response, the others are continuation records that name its identifier
as their origin, with their segment numbers, the last with the total length. So no record, and with
FILE_RECORDS no file, grows without bound. Spark's own text writer writes the records: the blank lines
that end a record are its line separator, and bytes pass through it unchanged. The files are gzipped.

Reading: files are read as binary by Spark, wherever they lie, and parsed as a stream, a record at a
time. Whole records are decoded in place. Segments are grouped by their origin identifier, ordered by
segment number and checked against the total length, then the transfer framing is decoded. A revisit
takes length and digest of the payload from the record it refers to.

Scale: pages with equal payloads are found on digests. Payloads that more than one page in common.HEAVY
has, of which there are at most HEAVY, meet by broadcast, all others by a plain join; nothing is gathered.
Equal copies of a segment collapse before segments are grouped, so a group holds one record. A task
reads as many files as Spark's bound on partition bytes lets it.

Status of a record: ok; "digest" (the block or the payload does not fit its digest), "length" (segments
are missing, contradict each other or do not fit the total length), "framing" (no sound HTTP message),
"orphan" (continuations without a first segment), "unresolved" (a revisit of a record that is not there
or has other content). What is not sound has a null payload.

Edge cases: a null html is an empty payload; very long ones are cut into segments; rows that repeat a
page_id and payload are all responses with one identifier, and each comes back; of pages without an id
none is the response unless all of the payload have none; a null url is written as about:blank, and
blanks and control characters in one are percent-encoded; an empty table gives an archive without
records; other columns of the pages are not read. Bytes that are no record are skipped up to the next
version line.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.llm.common import bound_batches, spread, stored
from pulsewatch.session import shared_dir

SEGMENT = 1 << 15  # bytes of a block in one record
CHUNK = 1 << 13  # bytes of a chunk of the transfer framing
FILE_RECORDS = 1024
DATE = "2000-01-01T00:00:00Z"
PREFIX = "urn:pulsewatch:page:"
_VERSION = re.compile(rb"WARC/\d+\.\d+\s*\Z")
_RECORD = (
    "record_id string, type string, target_uri string, date string, origin string, number int, total long, "
    "refers_to string, declared string, sound boolean, block binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, None if it is cut off or malformed."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]+", size):
            return None
        n, at = int(size, 16), end + 2
        if not n:
            trailers = body[at:]
            return b"".join(out) if trailers.startswith(b"\r\n") or b"\r\n\r\n" in trailers else None
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2


def http_payload(block: bytes) -> bytes | None:
    """The body of an HTTP message without its transfer framing."""
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        return None
    fields = dict(_field(line) for line in head.split(b"\r\n")[1:] if b":" in line)
    if "chunked" in fields.get("transfer-encoding", "").lower():
        return dechunked(body)
    length = fields.get("content-length", "")
    return body if not length.isdigit() or int(length) == len(body) else None


def _field(line: bytes) -> tuple[str, str]:
    name, _, value = line.partition(b":")
    return name.decode("utf-8", "replace").strip().lower(), value.decode("utf-8", "replace").strip()


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the blank lines that end it."""
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields], f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join([*lines, "", ""]).encode() + block


def identifier(page_id: object, payload: bytes) -> str:
    return f"{PREFIX}{'' if page_id is None else page_id}:{hashlib.sha256(payload).hexdigest()}"


def uri_of(url: str | None) -> str:
    return "about:blank" if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)


def page_records(page_id, url: str | None, payload: bytes, origin, segment: int, date: str) -> Iterator[bytes]:
    """The records of a page; ``origin`` is the page whose payload it repeats, if any."""
    own = identifier(page_id, payload)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    common = [("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    named = [("WARC-Record-ID", f"<{own}>"), ("WARC-Target-URI", uri_of(url)), *common]
    kind = ("Content-Type", "application/http; msgtype=response")
    if origin is not None:
        profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        yield record([("WARC-Type", "revisit"), *named, ("WARC-Refers-To", f"<{identifier(origin, payload)}>"), profile, kind], head)
        return
    block = head + chunked(payload)
    if len(block) <= segment:
        yield record([("WARC-Type", "response"), *named, kind], block)
        return
    yield record([("WARC-Type", "response"), *named, kind, ("WARC-Segment-Number", 1)], block[:segment])
    for number, at in enumerate(range(segment, len(block), segment), 2):
        fields = [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{own}:{number}>"), ("WARC-Target-URI", uri_of(url)), *common,
            ("WARC-Segment-Origin-ID", f"<{own}>"), ("WARC-Segment-Number", number),
        ]
        if at + segment >= len(block):
            fields.append(("WARC-Segment-Total-Length", len(block)))
        yield record(fields, block[at : at + segment])


def records_in(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of an uncompressed archive, one at a time."""
    while line := stream.readline():
        if not _VERSION.match(line):
            continue
        fields: dict[str, str] = {}
        last = None
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and last:
                fields[last] += " " + line.decode("utf-8", "replace").strip()
            else:
                last, value = _field(line)
                fields[last] = value
        size = fields.get("content-length", "")
        block = stream.read(int(size)) if size.isdigit() else b""
        expected = fields.get("warc-block-digest", "")
        sound = size.isdigit() and len(block) == int(size)
        if expected.startswith("sha1:"):
            sound = sound and expected[5:] == digest(block)

        def named(key: str, fields: dict[str, str] = fields) -> str | None:
            return fields[key].strip("<>") if key in fields else None

        def number(key: str, fields: dict[str, str] = fields) -> int | None:
            return int(fields[key]) if fields.get(key, "").isdigit() else None

        yield {
            "record_id": named("warc-record-id"), "type": fields.get("warc-type", ""), "target_uri": named("warc-target-uri"),
            "date": fields.get("warc-date"), "origin": named("warc-segment-origin-id"), "number": number("warc-segment-number"),
            "total": number("warc-segment-total-length"), "refers_to": named("warc-refers-to"),
            "declared": fields.get("warc-payload-digest"), "sound": sound, "block": block,
        }


def _opened(content: memoryview) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if bytes(content[:2]) == b"\x1f\x8b" else raw


def decoded(kind: str, block: bytes, declared: str | None, sound: bool) -> tuple[bytes | None, str]:
    """Payload and status of a whole record."""
    if not sound:
        return None, "digest"
    payload = http_payload(block) if kind in ("response", "request", "revisit") and block[:5] == b"HTTP/" else block
    if kind == "revisit":
        return None, "ok"
    if payload is None:
        return None, "framing"
    if declared and declared.startswith("sha1:") and declared[5:] != digest(payload):
        return None, "digest"
    return payload, "ok"


_READ = "record_id string, type string, target_uri string, date string, refers_to string, declared string, payload binary, status string"
_ARROW = pa.schema(
    [(c, pa.string()) for c in ("record_id", "type", "target_uri", "date", "refers_to", "declared")]
    + [("payload", pa.binary()), ("status", pa.string())]
)
_PARTS = pa.schema(
    [("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("origin", pa.string()),
     ("number", pa.int32()), ("total", pa.int64()), ("refers_to", pa.string()), ("declared", pa.string()), ("sound", pa.bool_()), ("block", pa.binary())]
)
BATCH_BYTES = 1 << 23


def _parsed(segmented: bool):
    """Whole records, decoded, or those that are segments, as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _PARTS if segmented else _ARROW
        rows: list[dict] = []
        size = 0
        for batch in batches:
            for content in batch.column("content"):
                for r in records_in(_opened(memoryview(content.as_buffer()))):
                    if (r["number"] is not None or r["type"] == "continuation") != segmented:
                        continue
                    size += len(r["block"])
                    if not segmented:
                        r["payload"], r["status"] = decoded(r["type"], r["block"], r["declared"], r["sound"])
                    rows.append({k: r[k] for k in schema.names})
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of one origin to payload and status."""
    schema = pa.schema([("origin", pa.string()), ("payload", pa.binary()), ("status", pa.string())])
    for batch in batches:
        for i in range(batch.num_rows):
            origin, kind, declared = (batch.column(c)[i].as_py() for c in ("origin", "type", "declared"))
            parts = sorted(batch.column("parts")[i].as_py(), key=lambda p: p["number"])
            totals = {p["total"] for p in parts if p["total"] is not None}
            block = b"".join(p["block"] for p in parts)
            complete = [p["number"] for p in parts] == list(range(1, len(parts) + 1)) and totals == {len(block)}
            sound = all(p["sound"] for p in parts)
            payload, status = decoded(kind, block, declared, sound) if complete else (None, "length")
            yield pa.RecordBatch.from_pylist([{"origin": origin, "payload": payload, "status": status}], schema)


def write(pages: DataFrame, path: str, least_bytes: int = 0, segment: int = SEGMENT, date: str = DATE) -> None:
    """Write ``pages`` (page_id, url, html) as archives below ``path``.

    Of pages with equal payloads of at least ``least_bytes`` the one with the largest page_id is a
    response, the others revisit it.
    """
    bound_batches(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha2("payload", 256))
    large = rows.where(F.length("payload") >= least_bytes)
    copies = large.groupBy("sha").agg(F.max("page_id").alias("origin"), F.count(F.lit(1)).alias("n"))
    copies = stored(copies.where("n > 1 and origin is not null"), "copies")
    placed = spread(rows, copies, "sha", pages.count())
    revisit = ~F.col("page_id").eqNullSafe(F.col("origin")) & F.col("origin").isNotNull()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in zip(*[batch.column(c) for c in ("page_id", "url", "payload", "origin")], strict=True):
                lines = list(page_records(*[v.as_py() for v in page], segment, date))
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["record"])

    shown = placed.select("page_id", "url", "payload", F.when(revisit, F.col("origin")).alias("origin"))
    lines = shown.mapInArrow(made, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.options(lineSep="\r\n\r\n", compression="gzip", maxRecordsPerFile=FILE_RECORDS).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, type, target_uri, date, refers_to, declared, payload, status) for each record below ``path``.

    Segments become one record. ``declared`` is the payload digest that the record gives.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    whole = files.mapInArrow(_parsed(False), _READ)
    segments = files.mapInArrow(_parsed(True), _RECORD).withColumn("origin", F.coalesce("origin", "record_id"))
    # copies of one segment collapse first; two that differ stay and spoil the length
    each = segments.groupBy("origin", "number", F.sha2("block", 256).alias("sha")).agg(
        F.first("block").alias("block"), F.max("total").alias("total"), F.min("sound").alias("sound"),
        F.max(F.when(F.col("type") != "continuation", F.col("type"))).alias("type"),
        F.max(F.when(F.col("type") != "continuation", F.col("declared"))).alias("declared"),
    )
    groups = each.groupBy("origin").agg(
        F.collect_list(F.struct(F.coalesce("number", F.lit(0)).alias("number"), "total", "sound", "block")).alias("parts"),
        F.coalesce(F.max("type"), F.lit("")).alias("type"), F.max("declared").alias("declared"),
    )
    bodies = groups.mapInArrow(_assembled, "origin string, payload binary, status string")
    heads = segments.where("type <> 'continuation'").drop("block", "number", "total", "sound")
    joined = heads.join(bodies, "origin", "full").select(
        F.coalesce("record_id", "origin").alias("record_id"),
        F.coalesce("type", F.lit("continuation")).alias("type"),
        "target_uri", "date", "refers_to", "declared",
        F.when(F.col("type").isNotNull(), F.col("payload")).alias("payload"),
        F.when(F.col("type").isNull(), F.lit("orphan")).otherwise(F.col("status")).alias("status"),
    )
    return whole.unionByName(joined)


def payload_digest(payload: str = "payload"):
    """Base32 of the SHA-1 in DataFrame functions: each four signs hold five hexadecimal digits."""
    signs = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.sha1(payload).substr(i * 5 + 1, F.lit(5)), 16, 10).cast("long")
    )

    def four(v):
        return F.concat(*[signs.substr((F.shiftright(v, s) % 32 + 1).cast("int"), F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(bits, four), "")


def resolved(records: DataFrame) -> DataFrame:
    """The records without payloads: payload_bytes and payload_digest, for a revisit those of what it refers to."""
    narrow = stored(
        records.select(
            "record_id", "type", "target_uri", "date", "refers_to", "declared", "status",
            F.length("payload").cast("long").alias("payload_bytes"),
            F.when(F.col("payload").isNotNull(), payload_digest()).alias("payload_digest"),
        ),
        "records",
    )
    revisits = narrow.where("type = 'revisit'").drop("payload_bytes", "payload_digest")
    wanted = revisits.groupBy("refers_to").agg(F.count(F.lit(1)).alias("n"))
    answers = (
        narrow.where("type <> 'revisit' and status = 'ok'").groupBy("record_id")
        .agg(F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
        .withColumnRenamed("record_id", "refers_to").join(wanted, "refers_to")
    )
    found = spread(revisits, stored(answers, "referred"), "refers_to", revisits.count())
    fits = F.col("declared").isNull() | (F.col("declared") == F.concat(F.lit("sha1:"), "payload_digest"))
    fits = F.coalesce(fits & F.col("payload_digest").isNotNull(), F.lit(False))
    found = found.withColumns(
        {
            "status": F.when((F.col("status") == "ok") & ~fits, F.lit("unresolved")).otherwise(F.col("status")),
            **{c: F.when(fits, F.col(c)) for c in ("payload_bytes", "payload_digest")},
        }
    )
    return narrow.where("type <> 'revisit'").unionByName(found)


def page_of(record_id: str, kind: str):
    """The page_id in an identifier that ``write`` gave."""
    return F.nullif(F.regexp_extract(record_id, f"^{PREFIX}(.*):[0-9a-f]{{64}}$", 1), F.lit("")).cast(kind)


def round_trip(pages: DataFrame, path: str | None = None, least_bytes: int = 0, segment: int = SEGMENT) -> DataFrame:
    """Write ``pages`` and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to, status."""
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path, least_bytes, segment)
    kind = pages.schema["page_id"].dataType.simpleString()
    return resolved(read(spark, path)).select(
        page_of("record_id", kind).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), page_of("refers_to", kind).alias("refers_to"), "status",
    )
