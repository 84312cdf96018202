"""WARC archives: a writer of gzip members, and a reader that salvages damaged files.

The writer makes one gzip member per record and hands the bytes to Spark's text
sink, so files are committed by Spark on any file system. The sink puts one
byte between rows: a member ends with the top byte of its length, which is zero
under 16 MiB, so rows leave that byte off and the separator restores it.

The reader checks every record (member checksum, version line, headers, length,
separator, payload digest). After a failed check it searches for the next gzip
member or version line that starts a valid record, recovers from there on, and
reports the bytes in between as a quarantined gap. Of a member that breaks off,
the records are recovered that stand whole in what could be decompressed.

The search is linear: where a header block ends is looked up once, and a failed
check says up to where no other start can succeed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.llm.common import bound_batches, written
from relcast.session import scratch_path

#: Payloads of at least so many bytes are stored once; equal ones refer to that record.
REVISIT_BYTES = 1000
#: An archive is closed once it has so many bytes or records, which bounds what a reading task holds at once.
ARCHIVE_BYTES = 64 << 20
ARCHIVE_RECORDS = 8192
GZIP_LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/(?:0\.1[78]|1\.[01])\r?\n")
_MEMBER = re.compile(re.escape(_MAGIC))
_HEADER_END = re.compile(rb"\r?\n\r?\n")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


@dataclass
class Record:
    offset: int
    end: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """The HTTP body of an HTTP record, else the block."""
        if self.headers.get("content-type", "").startswith("application/http"):
            m = _HEADER_END.search(self.block)
            return self.block[m.end():] if m else b""
        return self.block


@dataclass
class Gap:
    offset: int
    end: int
    reason: str


class Damaged(Exception):
    """A failed check.

    No plain record starts before ``skip``. ``content`` is what could be
    decompressed of a broken member; it is ``sound`` if nothing contradicts it.
    """

    def __init__(self, reason: str, skip: int = 0, content: bytes = b"", sound: bool = False):
        super().__init__(reason)
        self.skip, self.content, self.sound = skip, content, sound


class Finder:
    """First matches of a pattern at or behind growing places; what lies between is searched once."""

    def __init__(self, pattern: re.Pattern, data: bytes):
        self.pattern, self.data, self.asked, self.found = pattern, data, -1, None

    def __call__(self, at: int) -> re.Match | None:
        if self.asked < 0 or at < self.asked or (self.found is not None and self.found.start() < at):
            self.found = self.pattern.search(self.data, at)
            self.asked = at
        return self.found


# ------------------------------------------------------------------- writing

def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without payload if ``refers_to`` is given."""
    digest = hashlib.sha1(payload).digest()
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{page_urn(page_id)}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_UNSAFE.sub(lambda m: f'%{ord(m[0]):02X}', url) if url else 'about:blank'}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}", f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{page_urn(refers_to)}>"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_urn(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def gzip_member(data: bytes, level: int = GZIP_LEVEL) -> bytes:
    """One gzip member, followed by an empty one where the last byte would not be zero (from 16 MiB on)."""
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    member = pack.compress(data) + pack.flush()
    return member if member[-1] == 0 else member + gzip_member(b"")


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes a record per page (page_id, url, html) into archives below ``path``.

    A null html is an empty payload, a null url ``about:blank``. Of pages with
    equal payloads of at least REVISIT_BYTES, that with the largest page_id is
    a response and others revisit it; rows that repeat that page_id are
    responses too, since a record cannot revisit itself, and if all ids are
    null there is nothing to refer to and all are responses.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    key = F.sha2(F.col("html").cast("binary"), 256)
    large = rows.where(F.octet_length("html") >= REVISIT_BYTES)
    latest = large.groupBy(key.alias("k")).agg(F.max("page_id").alias("latest"), F.count("*").alias("n")).where((F.col("n") > 1) & F.col("latest").isNotNull())
    latest = written(latest.select("k", "latest"), "warc-copies")
    marked = rows.withColumn("key", key).join(latest, F.col("key") == F.col("k"), "left")
    marked = marked.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("latest")), F.col("latest")).alias("refers_to"))

    members = _dealt(marked.select("page_id", "url", "html", "refers_to"))
    (members.write.partitionBy("archive").option("lineSep", "\x00").option("maxRecordsPerFile", ARCHIVE_RECORDS)
     .mode("overwrite").text(path))


def _dealt(rows: DataFrame) -> DataFrame:
    """(member, archive): the members in order, and the number of the archive within the task, which changes once ARCHIVE_BYTES are full."""
    bound_batches(rows.sparkSession)
    schema = pa.schema([("member", pa.binary()), ("archive", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, size = 0, 0
        for batch in batches:
            members, archives = [], []
            for p, u, h, r in zip(*(c.to_pylist() for c in batch.columns)):
                members.append(gzip_member(record_bytes(p, u, h.encode("utf-8", "surrogatepass"), r))[:-1])
                archives.append(archive)
                size += len(members[-1]) + 1
                if size >= ARCHIVE_BYTES:
                    archive, size = archive + 1, 0
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary()), pa.array(archives, pa.int64())], schema=schema)

    return rows.mapInArrow(run, "member binary, archive long").select(F.col("member").cast("string").alias("member"), "archive")


# ------------------------------------------------------------------- reading

def parse_record(data: bytes, at: int, ends: Finder | None = None) -> Record:
    """The record at ``at`` in plain bytes; raises Damaged if any check fails."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    head_end = (ends or Finder(_HEADER_END, data))(version.end() - 2)
    if not head_end:
        raise Damaged("headers do not end", len(data))
    headers: dict[str, str] = {}
    name, pos = "", version.end()
    while pos < head_end.start():
        stop = data.find(b"\n", pos, head_end.start())
        stop = head_end.start() if stop < 0 else stop
        line = data[pos:stop].rstrip(b"\r")
        if line[:1] in (b" ", b"\t") and name:
            headers[name] += " " + line.strip().decode("utf-8", "replace")
        else:
            key, colon, value = line.partition(b":")
            if not colon:
                raise Damaged("header without a colon", pos)  # a start before this line has it too
            name = key.strip().decode("utf-8", "replace").lower()
            headers[name] = value.strip().decode("utf-8", "replace")
        pos = stop + 1
    # from here on, any other start before the end of these headers has them in part, and the same block
    beyond = head_end.start()
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit() or "warc-type" not in headers:
        raise Damaged("no length or type", beyond)
    start, end = head_end.end(), head_end.end() + int(length)
    if end > len(data):
        raise Damaged("block is cut off", beyond)
    close = _HEADER_END.match(data, end)
    if not close and end != len(data):
        raise Damaged("no separator behind the block", beyond)
    record = Record(at, close.end() if close else end, headers, data[start:end])
    wanted = digest_hex(headers.get("warc-payload-digest"))
    if wanted and headers["warc-type"] != "revisit" and hashlib.sha1(record.payload).hexdigest() != wanted:
        raise Damaged("payload digest differs", beyond)
    return record


def digest_hex(text: str | None) -> str | None:
    """The hex form of a sha1 digest header (base32 or hex); None for others."""
    kind, _, value = (text or "").partition(":")
    if kind.lower() != "sha1":
        return None
    if len(value) == 40:
        return value.lower()
    try:
        return base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


#: Longest name or comment in the header of a gzip member.
_MOST_NAME = 4096


def _member_starts(data: bytes, at: int) -> bool:
    """Whether a plausible gzip header stands at ``at``, so that a false start need not be read to the end."""
    flags = data[at + 3] if at + 3 < len(data) else 0xFF
    if flags & 0xE0:
        return False
    pos = at + 10
    if flags & 4:
        pos += 2 + int.from_bytes(data[pos:pos + 2], "little")
    for bit in (8, 16):
        if flags & bit:
            pos = data.find(b"\0", pos, pos + _MOST_NAME) + 1
            if not pos:
                return False
    return True


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at ``at``; raises Damaged, with what could be decompressed, if it is broken or cut off."""
    if not _member_starts(data, at):
        raise Damaged("no gzip header")
    unpack = zlib.decompressobj(31)
    parts, pos, size = [], at, 64  # steps grow: most false starts break at once
    while not unpack.eof and pos < len(data):
        step = data[pos:pos + size]
        size = min(4 * size, 1 << 16)
        before = unpack.copy()
        try:
            parts.append(unpack.decompress(step))
        except zlib.error as e:
            for k in range(0, len(step), 64):  # the step again in small parts, up to the one that breaks
                try:
                    parts.append(before.decompress(step[k:k + 64]))
                except zlib.error:
                    break
            raise Damaged(f"gzip: {e}", content=b"".join(parts)) from e
        pos += len(step)
    if not unpack.eof:
        raise Damaged("gzip member is cut off", content=b"".join(parts), sound=True)
    return b"".join(parts), pos - len(unpack.unused_data)


def _verified(record: Record) -> bool:
    """Whether the record states a digest of its payload (which was then checked)."""
    return record.headers["warc-type"] != "revisit" and digest_hex(record.headers.get("warc-payload-digest")) is not None


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records and gaps of an archive in order; together they cover all its bytes.

    Records in a member carry the member's byte range. A member that holds
    damaged records yields those that can be recovered, and a gap with the
    member's range for the rest. So does a member that breaks off: its records
    up to the break carry the range up to where the search goes on. Where its
    compressed data contradict themselves, records count only if their payload
    matches a digest.
    """
    pos, gap, ends, members, versions = 0, None, Finder(_HEADER_END, data), Finder(_MEMBER, data), Finder(_VERSION, data)
    while pos < len(data):
        try:
            if data.startswith(_MAGIC, pos):
                content, end = inflate(data, pos)
                found = [*salvage_plain(content)]
                if content and not any(isinstance(r, Record) for r in found):
                    raise Damaged("member without a record")
                items: list[Record | Gap] = [
                    Record(pos, end, r.headers, r.block) if isinstance(r, Record) else Gap(pos, end, f"{r.reason} (bytes {r.offset} to {r.end} of the member)")
                    for r in found]
            else:
                record = parse_record(data, pos, ends)
                items, end = [record], record.end
        except Damaged as e:
            next_ = (members(pos + 1), versions(max(pos + 1, e.skip)))
            end = min((m.start() for m in next_ if m), default=len(data))
            whole = [r for r in salvage_plain(e.content) if isinstance(r, Record) and (e.sound or _verified(r))] if e.content else []
            if whole:
                if gap:
                    yield gap
                yield from (Record(pos, end, r.headers, r.block) for r in whole)
                gap = Gap(pos, end, f"{e} (behind byte {whole[-1].end} of the member)")
            else:
                gap = gap or Gap(pos, pos, str(e))
            gap.end = pos = end
            continue
        if gap:
            yield gap
            gap = None
        yield from items
        pos = end
    if gap:
        yield gap


def salvage_plain(data: bytes) -> Iterator[Record | Gap]:
    """The same for uncompressed records alone."""
    pos, gap, ends, starts = 0, None, Finder(_HEADER_END, data), Finder(_VERSION, data)
    while pos < len(data):
        try:
            record = parse_record(data, pos, ends)
        except Damaged as e:
            gap = gap or Gap(pos, pos, str(e))
            m = starts(max(pos + 1, e.skip))
            pos = gap.end = m.start() if m else len(data)
            continue
        if gap:
            yield gap
            gap = None
        yield record
        pos = record.end
    if gap:
        yield gap


_READ = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("damage", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("uri", T.StringType()), T.StructField("refers_to", T.StringType()), T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType()),
])


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of the archives below ``path`` (any file names, gzip members or plain).

    One row per record, and one per quarantined gap, whose ``damage`` says why
    (null for records). ``payload_bytes`` and ``payload_digest`` (SHA-1, hex)
    are those of the payload as read, for revisits those of the payload they
    refer to as their headers state them. Without ``payloads`` that column is
    null. A task holds one archive at a time; an empty file has no rows.
    """
    bound_batches(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_READ)

    def row(name: str, item: Record | Gap) -> dict:
        out = dict.fromkeys(schema.names)
        out |= {"archive": name, "offset": item.offset, "end": item.end}
        if isinstance(item, Gap):
            return out | {"damage": item.reason}
        head, payload = item.headers, item.payload
        length, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if head["warc-type"] == "revisit":
            stated = head.get("x-payload-length", "")
            length, digest = int(stated) if stated.isascii() and stated.isdigit() else None, digest_hex(head.get("warc-payload-digest"))
        return out | {
            "record_type": head["warc-type"], "record_id": head.get("warc-record-id"), "uri": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"),
            "headers": list(head.items()), "payload_bytes": length, "payload_digest": digest, "payload": payload if payloads else None,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for item in salvage(content.as_py()):
                    rows.append(row(name, item))
                    size += 500 + (len(rows[-1]["payload"] or b""))
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.mapInArrow(run, _READ)


def op1_query(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives, reads these back and returns a row per page record."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    records = read_archives(spark, path, payloads=False).where(F.col("damage").isNull())
    return records.select(number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", number(F.col("refers_to")).alias("refers_to"))
