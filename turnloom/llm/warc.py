"""WARC archives: writing with segments and revisits, reading with segment reassembly.

Writing: each page becomes a response record, or a revisit of the page with the same payload and the smallest id, by the
id of that page's record. Responses carry the payload in chunked transfer framing. A block longer than ``segment_bytes``
is split: the first part is the response, continuation records follow with the origin's record id, their segment number
and, on the last one, the total length. Archives are files of WARC records, each a gzip member of its own, in any folder
that Spark can write.

Reading: archives are read and parsed once, gzip members and records one after the other, into a stored table; records
are cut at their content length, wherever record headers may appear in a payload. Continuations are grouped by the
identifier of their origin, put in the order of their segment numbers, and verified against the total length; then the
transfer framing is decoded. Only segmented records are shuffled. Revisits find their payload by a join.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm.shared import shared_folder, stored
from turnloom.session import map_arrow

VERSION, END = "WARC/1.1", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, complete boolean, payload_length long, payload binary"
_FIELDS = [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("complete", pa.bool_()), ("payload_length", pa.int64()), ("payload", pa.binary())]
_RECORD = pa.schema(_FIELDS)
#: A parsed record, or a segment of one: its origin, number, stated total length and block.
_PARSED = pa.schema([*_FIELDS, ("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()), ("block", pa.binary())])
PARSED = RECORD + ", origin string, segment long, total long, block binary"
#: An empty gzip member, which ends each archive (the sink needs something to end its rows with).
EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")


def base32(sha1_hex: Column) -> Column:
    """The bare upper-case base32 of a SHA-1 in hex: 40 bits (10 hex digits, 8 base32 digits) at a time."""
    fives = [F.lpad(F.conv(F.substring(sha1_hex, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*fives), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    return (VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    return b"".join(b"%x\r\n%b\r\n" % (len(part := payload[k : k + size]), part) for k in range(0, len(payload), size)) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes | None:
    """The payload of chunked transfer framing, chunk extensions and trailers ignored; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or set(size) - set(b"0123456789abcdefABCDEF"):
            return None
        length, at = int(size, 16), end + 2
        if length == 0:
            return b"".join(out)
        if body[at + length : at + length + 2] != b"\r\n":
            return None
        out.append(body[at : at + length])
        at += length + 2


def _member(data: bytes, level: int) -> bytes:
    """A gzip member."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _records(name: str, url: str | None, payload: bytes, sha1: bytes, refers_to: str | None, date: str, chunk_bytes: int, segment_bytes: int) -> list[bytes]:
    uri = quote(url, safe="/:?#[]@!$&'()*+,;=%~") if url else None
    digest = "sha1:" + base64.b32encode(sha1).decode()
    common = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest), ("Content-Type", "application/http;msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload)
        return [_header([("WARC-Type", "revisit"), ("WARC-Record-ID", name), ("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE), *common, ("Content-Length", str(len(block)))]) + block]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_header([("WARC-Type", "response"), ("WARC-Record-ID", name), *common, ("Content-Length", str(len(block)))]) + block]
    out = []
    starts = range(0, len(block), segment_bytes)
    for number, at in enumerate(starts, 1):
        part = block[at : at + segment_bytes]
        if number == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common, ("WARC-Segment-Number", "1")]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}.{number}>"), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(number))]
            fields += [("WARC-Segment-Total-Length", str(len(block)))] if number == len(starts) else []
        out.append(_header([*fields, ("Content-Length", str(len(part)))]) + part)
    return out


def _name(page_id: Column, sha1: Column, of_url: Column) -> Column:
    """The id of a page's record: of its id, payload and URL, so that equal rows have equal records."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"), sha1, F.lit(":"), F.lower(F.hex(of_url)), F.lit(">"))


def write(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", chunk_bytes: int = 16 << 10, segment_bytes: int = 64 << 10, archive_bytes: int = 16 << 20, level: int = 1) -> None:
    """Writes one WARC record per page (more where it is segmented) to archives of about archive_bytes each.

    Of pages with equal payloads of at least least_bytes, that with the smallest id is a response and the others revisit
    it. Null html is an empty payload, a null url leaves out the target; a page with a null id revisits one that has an
    id, and is a response where none has. Rows that repeat id, payload and URL are one and the same record, written as
    often as they occur. An empty table makes no archive with records; other columns, whatever their names, are not read.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "of_url": F.xxhash64(F.col("url").isNull(), "url")})
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "of_url"))).alias("first")
    known = rows.where(F.octet_length("payload") >= least_bytes).groupBy(F.col("sha1").alias("same")).agg(first, F.count(F.lit(1)).alias("n"))
    copies = stored(known.where("n > 1 AND first IS NOT NULL").select("same", F.col("first.page_id").alias("first_id"), F.col("first.of_url").alias("first_url")), "copies")
    refers = F.when(F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id")), _name(F.col("first_id"), F.col("sha1"), F.col("first_url")))
    typed = rows.join(copies, F.col("sha1") == F.col("same"), "left").select(_name(F.col("page_id"), F.col("sha1"), F.col("of_url")).alias("name"), "url", "payload", F.unhex("sha1").alias("sha1"), refers.alias("refers_to"))
    schema = pa.schema([("archive", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                for record in _records(*(x.as_py() for x in row), date, chunk_bytes, segment_bytes):
                    held.append(_member(record + END, level))
                    size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.record_batch([pa.array([b"".join(held)], pa.binary())], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.record_batch([pa.array([b"".join(held)], pa.binary())], schema=schema)

    # the text sink writes the bytes as they are, each archive to a file of its own, and ends it with an empty member
    archives = map_arrow(typed, run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("maxRecordsPerFile", 1).text(folder)


def _unpacked(archive: memoryview, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of an archive, plain or of any number of gzip members, in pieces; what is no gzip after a member ends it."""
    if bytes(archive[:2]) != b"\x1f\x8b":
        yield from (bytes(archive[k : k + step]) for k in range(0, len(archive), step))
        return
    at, unpacker = 0, zlib.decompressobj(31)
    while at < len(archive):
        data = bytes(archive[at : at + step])
        at += len(data)
        while data:
            try:
                piece = unpacker.decompress(data, step)
            except zlib.error:
                return
            if piece:
                yield piece
            if unpacker.eof:
                data, unpacker = unpacker.unused_data, zlib.decompressobj(31)
            else:
                data = unpacker.unconsumed_tail


def parse(archive: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """The records of an archive (plain or gzip): header fields by lower-case name, and the block.

    A header that can't be read, a block that is cut short, and other bytes between records give a record without a
    block; the next one is looked for behind it. The archive is unpacked and held in pieces, one record at a time.
    """
    pieces = _unpacked(memoryview(archive))
    data, at, ended = bytearray(), 0, False

    def more() -> bool:
        nonlocal at, ended
        piece = next(pieces, b"")
        if not piece:
            ended = True
            return False
        if at > 1 << 20:
            del data[:at]
            at = 0
        data.extend(piece)
        return True

    def holds(n: int) -> bool:
        while len(data) - at < n and more():
            pass
        return len(data) - at >= n

    def find(what: bytes, behind: int) -> int:
        """The place of some bytes counted from ``at``, or -1."""
        while (place := data.find(what, at + behind)) < 0:
            behind = max(behind, len(data) - at - len(what) + 1)
            if not more():
                return -1
        return place - at

    while True:
        while holds(1) and data[at] in b"\r\n":
            at += 1
        if not holds(1):
            return
        holds(5)
        fields: dict[str, str] = {}
        end = find(END, 0) if data.startswith(b"WARC/", at) else -1
        length = ""
        if end >= 0:
            for line in bytes(data[at : at + end]).decode("utf-8", "replace").split("\r\n")[1:]:
                name, colon, value = line.partition(":")
                if colon:
                    fields.setdefault(name.strip().lower(), value.strip())
            length = fields.get("content-length", "")
        if length.isascii() and length.isdigit() and len(length) < 16 and holds(end + 4 + int(length)):
            block = bytes(data[at + end + 4 : at + end + 4 + int(length)])
            at += end + 4 + int(length)
            yield fields, block
            continue
        yield fields, None
        behind = find(b"\nWARC/", 0)
        if behind < 0:
            return
        at += behind + 1


def _payload(block: bytes) -> tuple[bytes | None, int | None]:
    """The payload of an HTTP response block, and the length that its header states."""
    head, blank, body = block.partition(END)
    if not head.startswith(b"HTTP/"):
        return block, len(block)
    if not blank:
        return None, None
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    payload = dechunked(body) if fields.get(b"transfer-encoding", b"").lower().endswith(b"chunked") else body
    length = fields.get(b"content-length", b"")
    return payload, int(length) if length.isdigit() else None


def _record(record_id: str, kind: str, uri: str | None, digest: str | None, refers_to: str | None, block: bytes | None) -> tuple:
    """A row of RECORD. A revisit has no payload; a record is complete if its payload is whole and has the digest it states."""
    payload, length = (None, None) if block is None else _payload(block)
    if kind == "revisit":
        return record_id, kind, uri, digest, refers_to, block is not None, length, None
    found = payload is not None and (digest is None or digest == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode())
    return record_id, kind, uri, digest, refers_to, found, None if payload is None else len(payload), payload


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def _parsed(fields: dict[str, str], block: bytes | None) -> tuple:
    """A row of PARSED: a segment, or a record that is whole or can't be."""
    number, total = fields.get("warc-segment-number"), fields.get("warc-segment-total-length", "")
    name, kind, uri, digest = (fields.get(f"warc-{x}") for x in ("record-id", "type", "target-uri", "payload-digest"))
    if number is None or block is None or not (number.isascii() and number.isdigit() and len(number) < 16):
        return *_record(name or "", kind or "", uri, digest, fields.get("warc-refers-to"), None if number is not None else block), None, None, None, None
    origin = fields.get("warc-segment-origin-id") or name or ""
    return None, kind, uri, digest, None, None, None, None, origin, int(number), int(total) if total.isascii() and total.isdigit() and len(total) < 16 else None, block


def read(spark: SparkSession, folder: str, resolve: bool = False) -> DataFrame:
    """One row per record of the archives in a folder, segments put together: the columns of RECORD.

    resolve: revisits get the payload of the record that they refer to, where that is in the folder.

    complete is false, and the payload null, for a record with missing, repeated but different or surplus segments, with
    a total length that does not fit, with broken framing, or which is cut short or can't be read; false alone if the
    payload does not have the digest that the record states. Equal records stay as often as they are there. An archive is
    unpacked piece by piece, but comes to its task as one file, of at most the two gigabytes that Spark reads as one.
    An empty folder of archives gives no rows.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for fields, block in parse(memoryview(archive.as_buffer())):
                    rows.append(_parsed(fields, block))
                    size += len(block or b"")
                    if size >= 8 << 20:
                        yield _batch(rows, _PARSED)
                        rows, size = [], 0
                yield _batch(rows, _PARSED)

    parsed = stored(map_arrow(files, run, PARSED), "records")
    whole = parsed.where("segment IS NULL").select(*_RECORD.names)
    first = lambda name: F.max(F.when(F.col("segment") == 1, F.col(name))).alias(name)
    parts = parsed.where("segment IS NOT NULL").groupBy("origin", "segment", "total", "record_type", "target_uri", "payload_digest", "block").agg(F.count(F.lit(1)).alias("times"))
    together = parts.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("blocks"), F.max("total").alias("total"), F.count("total").alias("totals"), first("record_type"), first("target_uri"), first("payload_digest"),
        F.min("times").alias("times"),
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                block = b"".join(x["block"] for x in row["blocks"])
                fits = [x["segment"] for x in row["blocks"]] == list(range(1, len(row["blocks"]) + 1)) and row["totals"] == 1 and row["total"] == len(block)
                record = _record(row["origin"], row["record_type"] or "", row["target_uri"], row["payload_digest"], None, block if fits else None)
                for _ in range(row["times"] if fits else 1):
                    yield _batch([record], _RECORD)

    records = whole.unionByName(map_arrow(together, join, RECORD))
    if not resolve:
        return records
    found = _responses(records, "payload")
    return records.join(found, F.col("refers_to") == F.col("found_id"), "left").select(*[F.coalesce("payload", "found").alias("payload") if c == "payload" else F.col(c) for c in _RECORD.names])


def _responses(records: DataFrame, *columns: str) -> DataFrame:
    """found_id and found (or found_<name> for several columns): the complete records that a revisit refers to, once each."""
    wanted = records.where("record_type = 'revisit'").select(F.col("refers_to").alias("found_id")).distinct()
    names = ["found"] if len(columns) == 1 else [f"found_{c}" for c in columns]
    of = records.where("complete AND record_type <> 'revisit'").select(F.col("record_id").alias("found_id"), *[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    return of.join(wanted, "found_id", "left_semi").dropDuplicates(["found_id"])


def round_trip(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes archives of the pages, reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to, complete.

    payload_digest is that of the payload as read, in bare upper-case base32; a revisit's payload is that of the record
    it refers to, and complete is false for one whose reference is not there. A null id stays null; repeated rows give
    repeated rows; an empty table gives no rows; other columns, whatever their names, are not read. The archives stay in
    the folder (by default one of their own in the shared folder).
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, folder, id_col=id_col, url_col=url_col, html_col=html_col, least_bytes=least_bytes)
    of_page = lambda name: F.expr(f"try_cast(nullif(regexp_extract({name}, '<urn:page:(-?[0-9]+):', 1), '') AS bigint)")
    records = read(spark, folder).withColumn("digest", base32(F.sha1("payload")))
    found = _responses(records, "digest", "payload_length")
    revisit = F.col("record_type") == "revisit"
    return records.join(found, F.col("refers_to") == F.col("found_id"), "left").select(
        of_page("record_id").alias("page_id"), F.when(revisit, F.col("found_payload_length")).otherwise(F.col("payload_length")).alias("payload_bytes"), F.when(revisit, F.col("found_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", of_page("refers_to").alias("refers_to"), (F.col("complete") & (~revisit | F.col("found_digest").isNotNull())).alias("complete"),
    )


def sql() -> str:
    """DuckDB SQL for round_trip() over pages whose ids are not null."""
    digit = lambda k: f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((part >> {35 - 5 * k}) & 31 AS INTEGER) + 1, 1)"
    return f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages), parts AS (
  SELECT DISTINCT hex, k, CAST(concat('0x', substr(hex, 1 + 10 * k, 10)) AS BIGINT) AS part FROM payloads, (SELECT unnest([0, 1, 2, 3]) AS k)
), digests AS (SELECT hex, string_agg({" || ".join(digit(k) for k in range(8))}, '' ORDER BY k) AS payload_digest FROM parts GROUP BY hex), typed AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to, true AS complete
FROM typed JOIN digests USING (hex)
"""
