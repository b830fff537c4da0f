"""Operator 7: WARC archives, written by Spark and read back in splittable ranges.

Writing: one gzip member for each record, put together in ``mapInArrow`` and
written by Spark's own text writer, so archives go through Spark's commit
protocol to any store it can write. The writer ends each row with one
separator byte; a gzip member below 16 MiB ends in a zero byte (the top byte of
its length), so that byte is cut from the member and used as the separator.
The files are plain concatenated members, byte for byte; larger records are
followed by an empty member, which ends in a zero byte too.

Reading: Spark's text reader splits a file into byte ranges and looks for the
gzip magic as separator; a row starts at a magic inside the range and may end
beyond it. A candidate is a record only if its gzip header is valid and its
first decoded bytes are a WARC header. A magic that turns up inside compressed
data cuts a member in two: the pieces are joined again by decoding, within a
range at once, across ranges in a second, keyed step over those few pieces.

Defined results: a null html is an empty payload; a null url gives no target;
a null page_id gives a record without a number and never wins over a number;
rows repeating the winning page_id are all responses; an empty table writes
empty archives and reads as no rows; columns other than page_id, url and html
are ignored. A range that begins inside a stored (uncompressed) member holding
a whole WARC member takes that inner member for a record of its own.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermart.session import ensure_checkpoint_dir

from .common import write_table

#: Fixed values of the formats.
GZIP_MAGIC = b"\x1f\x8b\x08"
WARC_VERSION = b"WARC/1."
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

REVISIT_MIN_BYTES = 1000
LEVEL = 4
_FIELDS = "record_type string, page_id long, target_uri string, refers_to long, payload_bytes long, payload_digest string, payload binary"
_PARTS = _FIELDS + ", file string, block long, piece int, raw binary"


def _member(head: list[str], block: bytes, level: int) -> bytes:
    """One gzip member holding a WARC record; ends in a zero byte."""
    lines = ["WARC/1.1", *head, f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(level, wbits=31)
    data = z.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + z.flush()
    if data[-1]:
        z = zlib.compressobj(level, wbits=31)
        data += z.compress(b"") + z.flush()
    return data


def _record(page_id, url, html, digest, size, refers_to, date, level) -> bytes:
    target = [f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url)}"] if url is not None else []
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {date}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", *target,
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http;msgtype=response"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to is None:
        return _member(head, http + html, level)
    return _member([*head, f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"], http, level)


def write_archives(pages: DataFrame, path: str, level: int = LEVEL, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record for each row of ``pages`` (page_id, url, html) into archives under ``path``."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select("page_id", "url", body.alias("html"), F.sha1(body).alias("digest"), F.octet_length(body).alias("size"))
    last = write_table(p.where(F.col("size") >= REVISIT_MIN_BYTES).groupBy("digest")
                       .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null")
                       .select("digest", "last"), "payloads")
    p = p.join(last, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))).drop("last")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "size", "refers_to")]
            out = [_record(*row, date, level)[:-1] for row in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    members = p.mapInArrow(build, "value binary").select(F.col("value").cast("string"))
    members.write.option("lineSep", "\x00").option("compression", "none").text(path)


def _is_record(data: bytes) -> bool:
    """Whether ``data`` starts a gzip member whose first decoded bytes are a WARC header."""
    if len(data) < 10 or data[3] & 0xE0:
        return False
    try:
        return zlib.decompressobj(31).decompress(data, len(WARC_VERSION)) == WARC_VERSION
    except zlib.error:
        return False


class _Member:
    """A member being put together from the pieces that the magic cut it into."""

    def __init__(self):
        self.z, self.raw, self.out, self.bad = zlib.decompressobj(31), [], [], False

    def add(self, piece: bytes) -> bool:
        """Whether the member is whole now."""
        self.raw.append(piece)
        try:
            self.out.append(self.z.decompress(piece))
        except zlib.error:
            self.bad = True
        return self.z.eof


def _parse(data: bytes, with_payload: bool) -> tuple:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    number = lambda text: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", text or "")) else None
    block = rest[: int(fields.get("content-length", len(rest)))]
    payload = block.partition(b"\r\n\r\n")[2] if "application/http" in fields.get("content-type", "") else block
    kind, refers = fields.get("warc-type"), number(fields.get("warc-refers-to"))
    if kind == "revisit":
        size = int(fields["x-payload-length"]) if "x-payload-length" in fields else None
        return kind, number(fields.get("warc-record-id")), fields.get("warc-target-uri"), refers, size, fields.get("warc-payload-digest", "").removeprefix("sha1:"), None
    return (kind, number(fields.get("warc-record-id")), fields.get("warc-target-uri"), refers, len(payload),
            hashlib.sha1(payload).hexdigest(), payload if with_payload else None)


def _scan(rows: Iterator[tuple[bytes, str, int]], with_payload: bool) -> Iterator[tuple]:
    """Records of the ranges, in order; pieces that a range can't place come as raw rows."""
    at, member, piece = None, None, 0
    for value, file, block in rows:
        if (file, block) != at:
            if member:
                yield (*[None] * 7, *at, 1 << 30, b"".join(member.raw))
            at, member, piece, first = (file, block), None, 0, block == 0
        else:
            first = False
        if first:  # what stands before the first magic of a file
            continue
        data = GZIP_MAGIC + value
        if member is None:
            if not _is_record(data):
                yield (*[None] * 7, file, block, piece, data)
                piece += 1
                continue
            member = _Member()
        if member.add(data):
            yield (*_parse(b"".join(member.out), with_payload), None, None, None, None)
            member = None
        elif member.bad:
            member = None
    if member:
        yield (*[None] * 7, *at, 1 << 30, b"".join(member.raw))


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records under ``path``: record_type, page_id, target_uri, refers_to, payload_bytes, payload_digest, payload.

    Size and digest of a response are those of the payload read; a revisit has
    no payload and carries those of its header.
    """
    ranges = (spark.read.option("encoding", "ISO-8859-1").option("lineSep", GZIP_MAGIC.decode("latin-1")).text(path)
              .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block")))
    schema = pa.schema([("record_type", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
                        ("file", pa.string()), ("block", pa.int64()), ("piece", pa.int32()), ("raw", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("value", "file", "block")), strict=True))
        out, size = [], 0
        for r in _scan(rows, with_payload):
            out.append(r)
            size += 200 + len(r[6] or b"") + len(r[10] or b"")
            if size > 16_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    def stitch(pieces: pd.DataFrame) -> pd.DataFrame:
        found, member = [], None
        for data in pieces.sort_values(["block", "piece"])["raw"]:
            if member is None:
                if not _is_record(data):
                    continue
                member = _Member()
            if member.add(data):
                found.append(_parse(b"".join(member.out), with_payload))
            if member.z.eof or member.bad:
                member = None
        return pd.DataFrame(found, columns=schema.names[:7]).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

    parts = write_table(ranges.mapInArrow(scan, _PARTS), "records")
    names = schema.names[:7]
    broken = parts.where("raw is not null").groupBy("file").applyInPandas(stitch, _FIELDS)
    return parts.where("raw is null").select(*names).union(broken.select(*names))


def round_trip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write ``pages`` as archives into the shared checkpoint folder and read them back."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return read_archives(spark, path, with_payload)
