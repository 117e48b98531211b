"""WARC archives: a writer with revisit records and a salvage reader.

Writer. A record per row, one gzip member each, through Spark's own file writer and commit protocol:
the text writer emits the bytes of a member and, as line separator, an empty gzip member, so an
archive is a plain series of members and a lost task leaves nothing behind. A file holds
at most ``records_per_file`` records of one partition. Of rows with equal payloads of at least
``MIN_REVISIT`` bytes the smallest id is the response, others are revisits that carry
digest, length and id of it.

Salvage reader. Each archive is read member by member (or record by record if not
compressed). Checks: gzip length and checksum, version line, header block, Content-Length, end of
record, digest. After a failed check the reader searches for the next place that begins a valid member or version line, goes
on there, and logs the bytes between as a gap with the reason. A member may hold many records, whose offset and length
are those of the member; of a damaged member the bytes up to the damage are searched for records.

Defined cases: a null payload is empty; a null id, or a text that is no whole number, is written without id and read as null, and never
names a response that others refer to unless all ids are null; rows that repeat the smallest id are all
responses; line breaks in addresses are written as percent codes; an empty table gives no records;
columns of the input other than the three named are not written, so their names cannot clash; a very long payload is one record.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 100
RECORDS_PER_FILE = 5_000
VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
MEMBER = b"\x1f\x8b\x08"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
FIXED_DATE = "1970-01-01T00:00:00Z"
RECORDS = (
    "archive string, offset long, length long, record_type string, page_id long, url string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary, problem string"
)
FIELDS = [part.split()[0] for part in RECORDS.split(", ")]


def address(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str, date: str = FIXED_DATE
) -> bytes:
    """One record with its end; a revisit holds no payload."""
    body = payload if refers_to is None else b""
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Date: {date}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {address(url)}")
    if refers_to is not None:
        lines += ["WARC-Profile: identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(body)}")
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class Problem(Exception):
    """A failed check."""


class Record(NamedTuple):
    headers: dict[str, str]
    body: bytes
    size: int


def parse_record(data: bytes, at: int = 0) -> Record:
    """The record that starts at ``at``; ``size`` is its length with the end of the record."""
    if not VERSION_LINE.match(data, at):
        raise Problem("version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Problem("header block")
    headers = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Problem("header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise Problem("content length")
    begin = stop + 4
    end = begin + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Problem("end of record")
    body = data[begin:end]
    if headers.get("warc-type") == "response":
        kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
        if kind == "sha256" and digest != hashlib.sha256(body).hexdigest():
            raise Problem("payload digest")
    return Record(headers, body, end + 4 - at)


def read_member(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int, str | None]:
    """Content and end of the gzip member at ``at``, and the reason if it is damaged; length and checksum are verified.

    The input is fed in steps, so the rest of the file is not copied for each member. The step that fails is
    fed again byte by byte, so the content reaches up to the damage.
    """
    machine, out, to, view = zlib.decompressobj(31), [], at, memoryview(data)
    try:
        while not machine.eof and to < len(data):
            out.append(machine.decompress(view[to : to + step]))
            to = min(to + step, len(data))
    except zlib.error:
        machine, out = zlib.decompressobj(31), []
        try:
            for begin in range(at, to, step):
                out.append(machine.decompress(view[begin : begin + step]))
            for begin in range(to, len(data)):
                out.append(machine.decompress(view[begin : begin + 1]))
        except zlib.error:
            return b"".join(out), begin, "gzip member"
    if not machine.eof:
        return b"".join(out), to, "cut gzip member"
    return b"".join(out), to - len(machine.unused_data), None


def records_of(content: bytes) -> Iterator[tuple[Record | None, str | None]]:
    """(record, None) for every good record of a member's content, (None, reason) for every gap."""
    at = 0
    while at < len(content):
        try:
            record = parse_record(content, at)
            yield record, None
            at += record.size
        except Problem as e:
            yield None, str(e)
            at = _next_valid(content, at, False)


def _next_valid(data: bytes, at: int, packed: bool) -> int:
    """The first later offset that begins a valid member or record; the length of ``data`` if none does."""
    while True:
        if packed:
            at = data.find(MEMBER, at + 1)
        else:
            found = VERSION_LINE.search(data, at + 1)
            at = found.start() if found else -1
        if at < 0:
            return len(data)
        try:
            if packed:
                content, _, problem = read_member(data, at)
                if problem and not any(record for record, _ in records_of(content)):
                    continue
            else:
                parse_record(data, at)
            return at
        except Problem:
            continue


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | None, str | None]]:
    """(offset, length, record, None) for every good record, (offset, length, None, reason) for every gap."""
    packed = data.startswith(MEMBER) or not VERSION_LINE.search(data)
    at = 0
    while at < len(data):
        try:
            if packed:
                content, end, problem = read_member(data, at)
                found = list(records_of(content))
                if problem:
                    end = _next_valid(data, at, packed)
                    while found and found[-1][0] is None:
                        found.pop()
                    found.append((None, problem))
                for record, reason in found:
                    yield at, end - at, record, reason
                at = end
            else:
                record = parse_record(data, at)
                yield at, record.size, record, None
                at += record.size
        except Problem as e:
            to = _next_valid(data, at, packed)
            yield at, to - at, None, str(e)
            at = to


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
    records_per_file: int = RECORDS_PER_FILE, min_revisit: int = MIN_REVISIT,
) -> None:
    """Write ``pages`` as gzip archives below ``path``.

    Only digests that occur again meet their rows; adaptive execution splits a hot one.
    """
    data = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(f"`{id_col}`").try_cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), data.alias("payload"),
        F.sha2(data, 256).alias("digest"), F.octet_length(data).alias("size"),
    )
    first = (
        rows.where(F.col("size") >= min_revisit).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("digest").alias("seen"), "first")
    )
    known = rows.join(first.hint("shuffle_hash"), F.col("digest") == F.col("seen"), "left")
    again = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, url, body, digest, refers_to in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                out.append(gzip.compress(build_record(page, url, body, refers_to, digest), 6, mtime=0))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    chosen = known.select("page_id", "url", "payload", "digest", again.alias("refers_to"))
    packed = chosen.mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("value"))
    (
        packed.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row per record, and a row with ``problem`` per quarantined gap, of all archives below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def number(text: str | None) -> int | None:
        found = re.search(r"-?\d+", text or "")
        return int(found[0]) if found else None

    def fields(name: str, at: int, length: int, record: Record | None, problem: str | None) -> tuple:
        if record is None:
            return (name, at, length, None, None, None, None, None, None, None, problem)
        h = record.headers
        size = number(h.get("warc-payload-length"))
        return (
            name, at, length, h.get("warc-type"), number(h.get("warc-record-id")), h.get("warc-target-uri"),
            len(record.body) if size is None else size, h.get("warc-payload-digest", "").partition(":")[2] or None,
            number(h.get("warc-refers-to")), record.body if with_payload else None, None,
        )

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows: list[tuple] = []
                held = 0
                for found in salvage(data.as_py()):
                    rows.append(fields(name, *found))
                    held += found[1] if found[2] is None else found[2].size
                    if held > 1 << 22:
                        yield to_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield to_batch(rows)

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=FIELDS)

    return files.mapInArrow(run, RECORDS)


def archive_table(pages: DataFrame, path: str, with_payload: bool = False, **columns: str) -> DataFrame:
    """Write ``pages`` below ``path`` and read the archives back."""
    write_archives(pages, path, **columns)
    return read_archives(pages.sparkSession, path, with_payload)
