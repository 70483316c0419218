"""Legacy archive converter: ARC to WARC (operator 7).

``write_arc`` stores pages as ARC records, ``read_arc`` parses them by the
header line of the archive's version (1: five fields, 2: ten) and the declared
length, ``write_warc`` turns them into WARC records with synthesised ids,
dates, types and digests, and ``read_warc`` reads those back. Archives are
gzipped files written by Spark's text writer. A task begins a new file (in
another ``roll=<n>`` folder) once ``FILE_BYTES`` are written, so a file holds no
more than that and one record; reading streams through a file and holds one
record at a time.

Of records with equal payloads, the one with the largest page id is written as
a response, the others as revisits of it: their block is the HTTP header alone.

Defined cases: null or empty html is an empty payload; a null url is written as
``unknown:`` and white space in a url as ``%20``; a null page id counts as
smaller than any other, and if all are null all are responses, as are rows that
share the largest page id; an archive without records reads as none; a record
cut short by the end of its archive is dropped; a line that is no header of its
version is skipped to the next line; a record is an archive's description if it
is the first or plain text, its url begins with ``filedesc://`` and its body
with a version number, else it is a page of that url; archives that are not
gzipped are read as they are; a page header that is no whole number is none;
a page longer than ``FILE_BYTES`` ends its file; other columns are not archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from keelson.llm import text as W
from keelson.session import scratch_dir

FILE_BYTES = 256 << 20
#: Smallest payload that a revisit may stand for.
REVISIT_BYTES = 0
ARC_DATE = "20240101000000"
_V1 = "URL IP-address Archive-date Content-type Archive-length"
_V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
_FIELDS = {1: len(_V1.split()), 2: len(_V2.split())}
_BATCH_BYTES = 8 << 20
_PAGE_ID = re.compile(r"-?[0-9]{1,18}")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC -----------------------------------------------------------------

class ArcRecord(NamedTuple):
    version: int
    offset: int
    url: str
    ip: str
    date: str
    mime: str
    body: bytes
    described: bool = False


def _arc_writer(version: int, file_bytes: int):
    """(page_id, url, html) rows to ARC records and the file each belongs to, an archive description first in each."""
    about = f"{version} 0 keelson\n{_V1 if version == 1 else _V2}\n"
    first = _arc_line(version, "filedesc://pages.arc", "text/plain", len(about)).encode() + about.encode()

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for page, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), W.text_bytes(batch.column(2))):
                name = "" if page is None else f"X-Page-Id: {page}\r\n"
                body = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{name}"
                        f"Content-Length: {len(html)}\r\n\r\n").encode() + html
                place = "unknown:" if url is None else "%20".join(url.split()) if url.split() != [url] else url
                yield _arc_line(version, place or "unknown:", "text/html", len(body)).encode() + body

    return lambda batches: _rolled(records(batches), file_bytes, first)


def _rolled(records: Iterator[bytes], file_bytes: int, first: bytes | None = None) -> Iterator[pa.RecordBatch]:
    """(value, roll) batches: the roll goes up when a file is full, and ``first`` begins each file."""
    roll, in_file, held = 0, 0, 0
    out: list[bytes] = [] if first is None else [first]
    for record in records:
        out.append(record)
        held += len(record)
        in_file += len(record)
        if held > _BATCH_BYTES or in_file > file_bytes:
            yield _lines(out, roll)
            out, held = [], 0
        if in_file > file_bytes:
            roll, in_file = roll + 1, 0
            out = [] if first is None else [first]
    if held or out and roll == 0:        # an archive of no records has its description
        yield _lines(out, roll)


def _arc_line(version: int, url: str, mime: str, length: int) -> str:
    middle = "" if version == 1 else " 200 - - 0 pages.arc"
    return f"{url} 0.0.0.0 {ARC_DATE} {mime}{middle} {length}\n"


def _lines(records: list[bytes], roll: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(records, pa.binary()).cast(pa.string()), pa.array([roll] * len(records), pa.int32())],
                                      names=["value", "roll"])


def _write(rolled: DataFrame, path: str) -> None:
    """(value, roll) rows as gzipped files; a task's rows come in the order of their rolls."""
    (rolled.write.mode("append").partitionBy("roll").option("compression", "gzip").option("lineSep", "\n").text(path))


def write_arc(pages: DataFrame, path: str, version: int, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html", file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` as gzipped ARC files of a version, without a shuffle."""
    kept = pages.select(F.col(id_col).cast("long"), url_col, html_col)
    _write(kept.mapInArrow(_arc_writer(version, file_bytes), "value string, roll int"), path)


def _opened(data: bytes) -> io.BufferedReader:
    plain = io.BytesIO(data)
    return io.BufferedReader(gzip.GzipFile(fileobj=plain) if data[:2] == b"\x1f\x8b" else plain, 1 << 20)


def arc_records(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, gzipped or not, archive descriptions included.

    The version is that of the last description; before one, that of the
    header line's number of fields."""
    stream = _opened(data)
    version, at = 0, 0
    while line := stream.readline():
        offset, at = at, at + len(line)
        fields = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        described = fields[0].startswith("filedesc://") and (offset == 0 or fields[3:4] == ["text/plain"])
        if not line.strip() or not fields[-1].isdigit() or not described and len(fields) != _FIELDS.get(version, len(fields)):
            continue
        if len(fields) not in _FIELDS.values():
            continue
        body = stream.read(int(fields[-1]))
        at += len(body)
        if len(body) < int(fields[-1]):
            return
        said = body.split(b" ", 1)[0]
        described = described and said.isdigit()
        if described:
            version = int(said)
        of = version or (1 if len(fields) == _FIELDS[1] else 2)
        yield ArcRecord(of, offset, fields[0], fields[1], fields[2], fields[3], body, described)


_RECORD = ("archive string, offset bigint, version int, url string, ip string, date string, page_id bigint, "
           "http binary, payload binary, digest string")


def _arc_reader(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                name, rows, held = _archive_name(path.as_py()), [], 0
                for r in arc_records(content.as_py()):
                    if r.described:
                        continue
                    head, payload = _http_parts(r.body)
                    rows.append((name, r.offset, r.version, r.url, r.ip, r.date, _page_id(head),
                                 head if with_payload else b"", payload if with_payload else b"", sha1_base32(payload)))
                    held += len(r.body)
                    if held > _BATCH_BYTES:
                        yield _record_batch(rows)
                        rows, held = [], 0
                yield _record_batch(rows)
    return read


def _archive_name(path: str) -> str:
    """A file's name, with its roll where it has one: files of a task's rolls are named alike."""
    *_, folder, name = ["", *path.split("/")]
    return f"{folder}/{name}" if folder.startswith("roll=") else name


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.string())
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=[x.split()[0] for x in _RECORD.split(", ")])


def _http_parts(body: bytes) -> tuple[bytes, bytes]:
    """Status line and header lines, and the payload; what is not HTTP is all payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    head, _, payload = body.partition(b"\r\n\r\n")
    return head + b"\r\n\r\n", payload


def _header(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n"):
        if line.lower().startswith(name.lower() + b":"):
            return line.split(b":", 1)[1].strip().decode()
    return None


def _page_id(head: bytes) -> int | None:
    found = _header(head, b"X-Page-Id") or ""
    return int(found) if _PAGE_ID.fullmatch(found) else None


def read_arc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of the ARC files below ``path``, descriptions left out."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
            .mapInArrow(_arc_reader(with_payload), _RECORD))


# --- WARC ----------------------------------------------------------------

def record_id(archive: str, offset: int, url: str, date: str) -> str:
    """The same record gets the same id whenever it is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{offset}/{date}/{url}')}>"


def warc_date(date: str) -> str:
    """14 digits (or the first of them) as a WARC date."""
    d = date.ljust(4, "0")[:14] + "00000101000000"[len(date[:14].ljust(4, "0")):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(archive: str, offset: int, url: str, ip: str, date: str, page_id: int | None, http: bytes, payload: bytes,
                digest: str, refers_to: int | None) -> bytes:
    """A response, a revisit (``refers_to`` given) or, without HTTP, a resource."""
    kind = "revisit" if refers_to is not None else "response" if http else "resource"
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(archive, offset, url, date)}",
             f"WARC-Date: {warc_date(date)}", f"WARC-Target-URI: {url}", f"WARC-IP-Address: {ip}",
             f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
             "Content-Type: " + ("application/http; msgtype=response" if http else "application/octet-stream")]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"X-Refers-To-Page-Id: {refers_to}", f"X-Payload-Length: {len(payload)}"]
    lines.append(f"Content-Length: {len(block)}")
    # the text writer's line end completes the blank lines after a record
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r"


def _warc_writer(file_bytes: int):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                yield warc_record(*row)
    return lambda batches: _rolled(records(batches), file_bytes)


def write_warc(records: DataFrame, firsts: DataFrame, path: str, least: int = REVISIT_BYTES,
               file_bytes: int = FILE_BYTES) -> None:
    """Write ARC ``records`` as gzipped WARC files. ``firsts`` names for each
    digest the largest page id; the join is an ordinary one, whose large
    digests the adaptive planner splits."""
    known = records.join(firsts, "digest", "left")
    again = (F.octet_length("payload") >= least) & F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    _write(known.select("archive", "offset", "url", "ip", "date", "page_id", "http", "payload", "digest",
                        F.when(again, F.col("first")).alias("refers_to"))
           .mapInArrow(_warc_writer(file_bytes), "value string, roll int"), path)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields with lower-case names, block) of a gzipped WARC file."""
    stream = _opened(data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields.get("content-length", 0))
        block = stream.read(size)
        if len(block) < size:
            return
        yield fields, block


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _warc_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows: list[tuple] = []
            for fields, block in warc_records(content.as_py()):
                kind, said = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                size = int(fields.get("x-payload-length", 0))
                if kind != "revisit":
                    payload = _http_parts(block)[1]
                    size = len(payload)
                    if sha1_base32(payload) != said:
                        raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
                rows.append((_number(fields.get("x-page-id")), size, said, kind, _number(fields.get("x-refers-to-page-id"))))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)],
                                             names=[x.split()[0] for x in _READ.split(", ")])


def _number(x: str | None) -> int | None:
    return None if x is None else int(x)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record: page id, payload size and digest, type, and the page a revisit refers to."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
            .mapInArrow(_warc_reader, _READ))


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = REVISIT_BYTES) -> None:
    """Convert the ARC files below ``arc_path`` into WARC files at ``warc_path``."""
    firsts = read_arc(spark, arc_path, with_payload=False).groupBy("digest").agg(F.max("page_id").alias("first"))
    write_warc(read_arc(spark, arc_path), firsts, warc_path, least)


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Archive ``pages`` as ARC (version 1 and 2 for even and odd ids), convert, and read the WARC files back."""
    spark = pages.sparkSession
    arc, warc = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    odd = F.coalesce(F.col(columns.get("id_col", "page_id")) % 2 != 0, F.lit(False))
    write_arc(pages.where(~odd), f"{arc}/v1", 1, **columns)
    write_arc(pages.where(odd), f"{arc}/v2", 2, **columns)
    convert(spark, arc, warc)
    return read_warc(spark, warc)
