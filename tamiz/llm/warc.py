"""WARC archives: a writer with revisit records, and a reader that salvages.

Writing is a Spark plan: digests, headers and blocks are column expressions, and
the text sink writes one record per row with the record end as line separator.
Of records with equal payloads the one with the smallest id is the response,
the others are revisits without a block that refer to it.

The reader takes plain archives and archives of gzip members.  Every record is
checked: member checksum, version line, header lines, ``Content-Length``, the
record end, block and payload digests.  After a failed check it looks for the
next gzip member or version line that starts a record passing all checks, goes
on from there, and returns the skipped bytes as a gap with the reason.  What a
gzip member inflates to, also before an error, is salvaged in the same way.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tamiz.llm.frames import broadcast_if_small, scratch_of, ship_package

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ID_PREFIX = "urn:x-page:"
PAYLOAD_LENGTH = "X-Payload-Length"
#: Most records and bytes in a file, which is read by one task; a longer record has
#: a file of its own.
RECORDS_PER_FILE, FILE_BYTES = 4000, 128 << 20
#: Bytes of a header besides the URL and the ids.
HEADER_REST = 1024

RECORDS = (
    "path string, offset bigint, length bigint, problem string, "
    "headers map<string,string>, payload binary"
)


def base32_sha1(content: Column) -> Column:
    """Bare upper-case base32 SHA-1: eight digits for every five bytes."""
    hexadecimal = F.sha1(content)
    digits = F.concat(
        *[F.lpad(F.conv(F.substring(hexadecimal, 10 * n + 1, 10), 16, 32), 8, "0") for n in range(4)]
    )
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32_DIGITS)


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """One record for each row of ``pages`` into archives under ``path``.

    Payloads of at least ``least_bytes`` bytes that occur under several ids are
    written once.  Long records go to files of fewer records.  A null payload is an empty one.  A row without id is always a
    response; rows that repeat whole, id included, are responses each.  A null
    URL leaves the header out; blanks and control characters in it are escaped.
    """
    scratch = scratch_of(pages)
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html")
    ).withColumn("digest", base32_sha1(F.col("html")))
    shared = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(
        F.min("id").alias("first"), F.max("id").alias("last")
    ).where("first < last").select("digest", "first")
    shared = scratch.stage(shared, "shared")
    marked = rows.join(broadcast_if_small(shared, 64), "digest", "left")
    halvings = _halvings()
    found = sorted(row[0] for row in rows.select(halvings.alias("n")).distinct().collect()) or [0]  # about 20 at most
    for n in found:
        records = marked.where(halvings == n).select(_record(date).alias("value"))
        writer = records.write.option("lineSep", END).option("maxRecordsPerFile", max(1, RECORDS_PER_FILE >> n))
        writer.mode("error" if n == found[0] else "append").text(path)


def _halvings() -> Column:
    """How often the records of a file are to be halved for records as long as this."""
    names = F.coalesce(F.octet_length("url"), F.lit(0)) + F.coalesce(F.octet_length(F.col("id").cast("string")), F.lit(0))
    size = F.octet_length("html").cast("bigint") + 3 * names + HEADER_REST  # a blank is three bytes
    return F.greatest(F.lit(0), F.ceil(F.log2(size * RECORDS_PER_FILE / FILE_BYTES))).cast("int")


def _record(date: str) -> Column:
    html, size = F.col("html"), F.octet_length("html").cast("string")
    revisit = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END)
    )
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, html))
    escaped = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    name = lambda page: F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), escaped),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("WARC-Block-Digest: sha1:"), base32_sha1(block)),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit(f"{PAYLOAD_LENGTH}: "), size),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)  # nulls are left out


# -- reading ------------------------------------------------------------------


class BadRecord(Exception):
    pass


def _digest_fits(stated: str | None, content: bytes) -> bool:
    if stated is None or not stated.startswith("sha1:"):
        return True
    return base64.b32encode(hashlib.sha1(content).digest()).decode() == stated[5:]


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and end of the plain record at ``at``; raises BadRecord."""
    if not data.startswith(b"WARC/1.", at):
        raise BadRecord("no version line")
    headers, line = {}, at
    while True:  # line by line: a header has any length, junk ends at its first bad line
        line = data.find(b"\r\n", line) + 2
        stop = data.find(b"\r\n", line)
        if line < 2 or stop < 0:
            raise BadRecord("no end of header")
        if stop == line:
            break
        name, colon, value = data[line:stop].decode("utf-8", "replace").partition(":")
        if not colon or not re.fullmatch(r"[!-~]+", name):
            raise BadRecord("malformed header line")
        headers[name] = value.strip()
    length = headers.get("Content-Length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise BadRecord("no content length")
    begin, end = line + 2, line + 2 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise BadRecord("no record end after the content")
    block = data[begin:end]
    if not _digest_fits(headers.get("WARC-Block-Digest"), block):
        raise BadRecord("block digest differs")
    payload = block
    if headers.get("Content-Type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    if headers.get("WARC-Type") == "response" and not _digest_fits(headers.get("WARC-Payload-Digest"), payload):
        raise BadRecord("payload digest differs")
    return headers, payload, end + 4


_Row = tuple[str | None, dict[str, str], bytes]  # problem, headers, payload


def _inflated(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``at`` holds up to its end or an error, where it
    ends, and what is wrong with it."""
    inflate, parts, view = zlib.decompressobj(31), [], memoryview(data)
    while at < len(data) and not inflate.eof:
        piece = view[at : at + (1 << 16)]
        before = inflate.copy()
        try:
            parts.append(inflate.decompress(piece))
        except zlib.error:
            for n in range(len(piece)):  # up to the byte that fails
                try:
                    parts.append(before.decompress(piece[n : n + 1]))
                except zlib.error:
                    break
            return b"".join(parts), at, "damaged gzip member"
        at += len(piece)
    return b"".join(parts), at - len(inflate.unused_data), None if inflate.eof else "cut gzip member"


def _inner_rows(plain: bytes, problem: str | None) -> Iterator[_Row]:
    """Records and gaps of an inflated member.  Of a damaged one only records whose
    digest says that they are whole are taken."""
    at = gap = 0
    reason = None
    starts = _VERSION_LINE.finditer(plain)
    while at < len(plain):
        try:
            headers, payload, end = parse_record(plain, at)
            if problem == "damaged gzip member" and not headers.get("WARC-Block-Digest", "").startswith("sha1:"):
                raise BadRecord("no digest in a damaged gzip member")
        except BadRecord as bad:
            reason = reason or str(bad)
            at = next((m.start() for m in starts if m.start() > at), len(plain))
            continue
        if reason:
            yield f"bytes {gap} to {at} of a gzip member: {reason}", {}, b""
        yield None, headers, payload
        at = gap = end
        reason = None
    if reason or problem == "cut gzip member":
        yield f"bytes from {gap} of a gzip member: {problem or reason}", {}, b""


def _rows_at(data: bytes, at: int) -> tuple[list[_Row], int | None, bytes]:
    """The record, or the rows of the gzip member, at ``at``, where it ends (None if
    that is not known), and what an unfinished member inflated to; raises BadRecord
    if there is no record."""
    if not data.startswith(b"\x1f\x8b", at):
        headers, payload, end = parse_record(data, at)
        return [(None, headers, payload)], end, b""
    plain, end, problem = _inflated(data, at)
    rows = list(_inner_rows(plain, problem))
    # A cut member whose only record is whole, as when the last bytes of a file are
    # missing, is quarantined like one whose record is cut.
    sole = problem == "cut gzip member" and len(rows) == 2 and rows[1][0].startswith(f"bytes from {len(plain)} ")
    if sole or not any(row[0] is None for row in rows):
        raise BadRecord(problem or (rows[0][0] if rows else "empty gzip member"))
    return (rows, None, plain) if problem else (rows, end, b"")


_STARTS, _VERSION_LINE = re.compile(rb"\x1f\x8b\x08|WARC/1\."), re.compile(rb"WARC/1\.")


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict[str, str], bytes]]:
    """(offset, length, problem, headers, payload): records, where ``problem`` is
    None, and quarantined gaps, in the order of the file.  What comes from a gzip
    member of several rows has the member's offset and length in each of them."""
    at, ready = 0, None
    while at < len(data):
        rows, end, plain = [], None, b""
        try:
            rows, end, plain = ready or _rows_at(data, at)
        except BadRecord as bad:
            rows = [(str(bad), {}, b"")]
        ready = None
        if end is None:
            end = len(data)
            for candidate in _STARTS.finditer(data, at + 1):
                start = candidate.start()
                try:
                    ready = _rows_at(data, start)
                except BadRecord:
                    continue
                if plain and data[start] != 0x1F and data[start : ready[1]] in plain:
                    ready = None  # stored, not compressed, in the member: it has come with it
                    continue
                end = start
                break
        for problem, headers, payload in rows:
            yield at, end - at, problem, headers, payload
        at = end


def _salvaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "offset", "length", "problem", "headers", "payload"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            held, size = [], 0
            for offset, length, problem, headers, payload in salvage(content.as_py() or b""):
                held.append((path, offset, length, problem, list(headers.items()), payload))
                size += len(payload)
                if size > 4 << 20:
                    yield _batch(held, names, kinds)
                    held, size = [], 0
            yield _batch(held, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives under ``path``: file, byte offset and
    length, ``problem`` (null for a record, else why the bytes are quarantined),
    headers, payload.  A file is one task's work and must fit into its memory;
    an empty file has neither records nor gaps."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_salvaged, RECORDS)
