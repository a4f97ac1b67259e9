"""Operator 6: WARC writing and reading, with segmented records and chunked transfer framing.

Writing: one response or revisit record per page. Response blocks are HTTP messages with a chunked
body; blocks over SEGMENT bytes continue in `continuation` records. Records are text (payloads are
UTF-8, and cuts fall between characters), so Spark's text writer with the record end as its line
end makes the archive files. Reading: every file is parsed once, record by record, plain or gzipped (one
member per file or per record), WARC 1.0 and 1.1; continuation records are grouped by their origin's id, put
in order of segment number, held against the total length, and the chunked framing is taken off. Segments
that all stand in one file are joined as it is read; only the others are shuffled to meet.
Revisits get their payload's length from the record they refer to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm.common import shared_dir, staged, table

#: Blocks longer than this are continued: most pages are.
SEGMENT = 1 << 11
CHUNK = 1 << 10
RECORDS_PER_FILE = 2048
#: Of the archives: half the default level's time for a write of check_l (8.4 s, not 15.5), 9 % more bytes (114 MB, not 104).
GZIP_LEVEL = "TWO"
#: Bytes of segments that wait for others of their origin while a file is read, and of blocks sent on together.
WAITING, SENT = 16 << 20, 16 << 20
LEAST_REVISIT = 100
END = b"\r\n\r\n"
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PARSED = "record_id string, type string, page_id long, url string, digest string, refers_to long, refers_id string, origin string, segment int, total long, block binary"
NAMES = [c.split()[0] for c in PARSED.split(", ")]
TYPE, PAGE, URL, DIGEST, ORIGIN, NUMBER, TOTAL, BLOCK = (NAMES.index(c) for c in ("type", "page_id", "url", "digest", "origin", "segment", "total", "block"))
FOUND = "record_id string, page_id long, url string, digest string, size long, payload binary"


def cuts(data: bytes, step: int) -> list[bytes]:
    """Pieces of at most `step` bytes that begin at UTF-8 characters; at least one piece."""
    out, at = [], 0
    while len(data) - at > step:
        to = at + step
        while data[to] & 0xC0 == 0x80:
            to -= 1
        out.append(data[at:to])
        at = to
    return [*out, data[at:]]


def chunked(payload: bytes) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in cuts(payload, CHUNK) if c]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        out.append(body[at : at + size])
        if len(out[-1]) != size or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        at += size + 2


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}|{digest}'.encode()).hexdigest())}>"


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without its closing two line ends."""
    lines = [f"{k}: {v}".replace("\r", " ").replace("\n", " ") for k, v in [*headers, ("Content-Length", len(block))] if v is not None]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode("utf-8", "replace") + END + block


def records_of(page_id, url, html: bytes, digest: str, first, segment: int) -> list[bytes]:
    own = record_id(page_id, digest)
    head: list[tuple[str, object]] = [("WARC-Type", None), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("X-Page-ID", page_id), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if first is not None:
        head[0] = ("WARC-Type", "revisit")
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(first, digest)), ("X-Refers-To-Page", first)]
        return [record(head, b"")]
    head[0] = ("WARC-Type", "response")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(html)
    parts = cuts(block, segment)
    head.append(("Content-Type", "application/http; msgtype=response"))
    if len(parts) == 1:
        return [record(head, block)]
    out = [record([*head, ("WARC-Segment-Number", 1)], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        total = len(block) if n == len(parts) else None
        out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{own}|{n}'.encode()).hexdigest())}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", total)], part))
    return out


def write_warc(pages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Write page_id, url, html as gzipped archive files under path.

    pages: page_id, url, html; other columns are ignored. Of pages with equal payloads of at least
    LEAST_REVISIT bytes, the one with the smallest page_id is a response and the others revisit it. Null html is an empty payload; a null page_id is never
    the one referred to while another has the payload.
    """
    digest = F.sha2(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 256)
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), digest.alias("digest"))
    same = rows.where(F.octet_length("html") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rows = rows.join(same, "digest", "left").withColumn("first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                made = [r for row in zip(*(c.to_pylist() for c in part.columns)) for r in records_of(*row, segment)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()).view(pa.string())], ["value"])

    made = rows.select("page_id", "url", "html", "digest", "first").mapInArrow(run, "value string")
    made.write.option("lineSep", END.decode()).option("compression", "gzip").option("zlib.compress.level", GZIP_LEVEL).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def header_lines(raw: list[bytes]) -> dict[str, str]:
    """Named fields, names in lower case; lines that begin with a blank go on with the field before."""
    out: dict[str, str] = {}
    name = ""
    for line in raw:
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name:
            out[name] += " " + text.strip()
        elif ":" in text:
            name, value = text.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def parse(stream: BinaryIO) -> Iterator[tuple]:
    """The records of one archive file, read one after another."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record: {line[:40]!r}")
        raw = []
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError("header cut short")
            raw.append(line)
        head = header_lines(raw)
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"{head.get('warc-record-id')}: record is cut short")
        number = lambda k: int(head[k]) if k in head else None
        url = head.get("warc-target-uri")
        url = url[1:-1] if url and url.startswith("<") and url.endswith(">") else url
        yield head["warc-record-id"], head["warc-type"].lower(), number("x-page-id"), url, head.get("warc-payload-digest"), number("x-refers-to-page"), head.get("warc-refers-to"), head.get("warc-segment-origin-id"), number("warc-segment-number"), number("warc-segment-total-length"), block


def opened(content: bytes) -> BinaryIO:
    """A gzipped file's members are read one after another, as they are needed."""
    plain = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=plain), 1 << 16) if content[:2] == b"\x1f\x8b" else plain


def deflated(row: tuple) -> tuple:
    """Blocks of segments are deflated until they are joined."""
    return row[:-1] + (zlib.compress(row[BLOCK], 1),) if row[NUMBER] is not None else row


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archive files under path. Blocks of segments are deflated."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                rows, size = [], 0
                for row in parse(opened(content)):
                    rows.append(deflated(row))
                    size += len(row[BLOCK])
                    if size > SENT:
                        yield framed(rows)
                        rows, size = [], 0
                yield framed(rows)

    def framed(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=NAMES).astype({c: "Int64" for c in ("page_id", "refers_to", "segment", "total")})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, PARSED)


def whole(numbers: list[int], total: int | None, block: bytes, rid: str) -> bytes:
    """The block of segments with those numbers; ValueError unless they are all there."""
    if numbers != list(range(1, len(numbers) + 1)) or total != len(block):
        raise ValueError(f"{rid}: segments {numbers} of {len(block)} bytes, total {total}")
    return block


def gathered(records: Iterator[tuple]) -> Iterator[tuple]:
    """The records of a file, the segments of an origin as one record where all stand in it.

    Where a number comes twice before the origin is complete, or more than WAITING bytes wait, the
    segments, and those of the origin that follow, go on one by one.
    """
    waiting: dict[str, dict[int, tuple]] = {}
    apart: set[str] = set()
    size = 0
    for row in records:
        number = row[NUMBER]
        if number is None:
            yield row
            continue
        rid = row[ORIGIN] or row[0]
        parts = waiting.setdefault(rid, {})
        if rid in apart or number in parts:
            apart.add(rid)
            yield from (*parts.values(), row)
            size -= sum(len(p[BLOCK]) for p in waiting.pop(rid).values())
            continue
        parts[number] = row
        size += len(row[BLOCK])
        last = parts[max(parts)]
        if last[TOTAL] is not None and len(parts) == last[NUMBER] and min(parts) == 1:
            del waiting[rid]
            block = b"".join(parts[n][BLOCK] for n in sorted(parts))
            size -= len(block)
            yield *parts[1][:NUMBER], None, None, whole(sorted(parts), last[TOTAL], block, rid)
        elif size > WAITING:
            apart.update(waiting)
            yield from (p for parts in waiting.values() for p in parts.values())
            waiting, size = {}, 0
    yield from (p for parts in waiting.values() for p in parts.values())


def checked(rid: str, block: bytes, digest: str | None) -> tuple[str, bytes]:
    """SHA-256 and payload of a response block, held against its digest if that is of a known kind."""
    head, body = block.split(END, 1)
    fields = header_lines(head.split(b"\r\n")[1:])
    payload = unchunked(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body
    own = hashlib.sha256(payload).hexdigest()
    kind, _, value = (digest or "").partition(":")
    found = {"sha256": own, "sha1": base64.b32encode(hashlib.sha1(payload).digest()).decode()}.get(kind.lower()) if kind else None
    if found is not None and found.lower() != value.lower():
        raise ValueError(f"{rid}: payload digest differs")
    return own, payload


def read_once(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """Responses with their payloads and sizes, revisits, and segments whose others stand elsewhere, staged."""
    schema = f"{PARSED}, size long, payload binary"
    types = spark.createDataFrame([], schema).schema
    arrow = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, size = [], 0
                for row in gathered(parse(opened(content))):
                    if row[NUMBER] is not None:
                        rows.append((*deflated(row), None, None))
                    elif row[TYPE] == "response":
                        digest, payload = checked(row[0], row[BLOCK], row[DIGEST])
                        rows.append((*row[:DIGEST], digest, *row[DIGEST + 1 : BLOCK], None, len(payload), payload if payloads else None))
                    elif row[TYPE] == "revisit":
                        rows.append((*row[:BLOCK], None, None, None))
                    size += len(row[BLOCK])
                    if size > SENT:
                        yield framed(rows)
                        rows, size = [], 0
                if rows:
                    yield framed(rows)

    def framed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow)], types.fieldNames())

    return staged(spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema), "records")


def joined(payloads: bool):
    """Joins the segments of each origin, checks numbers and total length, and takes the framing off.

    A record that was written n times has each segment n times, and comes out n times.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rid, page, url, digest, segments in zip(pdf["record_id"], pdf["page_id"], pdf["url"], pdf["digest"], pdf["segments"]):
                copies: dict[int, list] = {}
                for s in segments:
                    copies.setdefault(s["segment"], []).append(s)
                numbers, times = sorted(copies), len(copies.get(1, []))
                if not all(len(c) == times and all(bytes(s["block"]) == bytes(c[0]["block"]) for s in c) for c in copies.values()):
                    raise ValueError(f"{rid}: segments {numbers} differ or do not come alike often")
                block = b"".join(zlib.decompress(copies[n][0]["block"]) for n in numbers)
                digest, payload = checked(rid, whole(numbers, copies[numbers[-1]][0]["total"], block, rid), digest)
                rows += [(rid, page, url, digest, len(payload), payload if payloads else None)] * times
            yield pd.DataFrame(rows, columns=["record_id", "page_id", "url", "digest", "size", "payload"]).astype({"page_id": "Int64"})

    return run


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per response or revisit record: page_id, url, record_type, refers_to, digest, payload_bytes, payload.

    Records of other types are left out. The digest is the payload's SHA-256 in hex; a revisit's is as
    stated in its record. The payload of a revisit is null (payloads=False: of every record, though it is
    read and checked); its length is that of the record it refers
    to. Segments missing, out of number or of another total length, broken framing and wrong digests
    raise an error. Records written twice are read twice. An empty archive gives an empty result.
    """
    every = read_once(spark, path, payloads)
    cut = every.where("segment is not null").groupBy(F.coalesce("origin", "record_id").alias("record_id"))
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    cut = cut.agg(first("type"), first("page_id"), first("url"), first("digest"), F.collect_list(F.struct("segment", "block", "total")).alias("segments")).where("coalesce(type, 'response') = 'response'")
    responses = every.where("type = 'response' and segment is null").select(*[c.split()[0] for c in FOUND.split(", ")])
    responses = responses.unionByName(cut.select("record_id", "page_id", "url", "digest", "segments").mapInPandas(joined(payloads), FOUND))
    shape = lambda df, kind, refers, size, payload: df.select("page_id", "url", F.lit(kind).alias("record_type"), refers.alias("refers_to"), "digest", size.cast("long").alias("payload_bytes"), payload.alias("payload"))
    sizes = responses.groupBy(F.col("record_id").alias("refers_id")).agg(F.max("size").alias("size"))
    revisits = every.where("type = 'revisit'").select("page_id", "url", F.regexp_replace("digest", "^sha256:", "").alias("digest"), "refers_to", "refers_id").join(sizes, "refers_id", "left")
    return shape(responses, "response", F.lit(None).cast("long"), F.col("size"), F.col("payload")).unionByName(shape(revisits, "revisit", F.col("refers_to"), F.col("size"), F.lit(None).cast("binary")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/lotline-{uuid.uuid4().hex}/warc"
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, payloads=False).select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


OP6_SQL = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
  select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by payload_digest
)
select p.page_id, cast(payload_bytes as bigint) as payload_bytes, p.payload_digest,
  case when f.first <> p.page_id then 'revisit' else 'response' end as record_type,
  case when f.first <> p.page_id then f.first end as refers_to
from p left join f on p.payload_digest = f.payload_digest and p.payload_bytes >= 100
"""
