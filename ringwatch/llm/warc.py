"""WARC archives: writing, and a splittable reader.

The reader cuts every file into byte ranges. A task looks for the gzip magic in its
range, takes a hit for a record only if the member there decodes to a WARC header,
and owns the records that start inside its range, reading past the end for the last.
"""

import gzip
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm.common import dealt
from ringwatch.session import Scratch, scratch_for

# Fixed values of the format.
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads below this are never stored as revisits.
MIN_REVISIT_BYTES = 100
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
#: Bytes that are decoded at first to look for a header; a longer one is read on.
HEADER_BYTES = 1 << 16


def open_filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it; a bare or ``file:`` path is local."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


# Writing


def _record(row) -> bytes:
    """One record as a gzip member of its own. A revisit names its response and has no body."""
    payload = row["payload"]
    revisit = row["record_type"] == "revisit"
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, row['record'])}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", (row["uri"] or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("X-Page-ID", "" if row["page_id"] is None else str(row["page_id"])),
    ]
    if revisit:
        refers = "" if row["refers_to"] is None else str(row["refers_to"])
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", refers)]
    body = b"" if revisit else payload
    fields += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    head = CRLF.join([VERSION, *[f"{k}: {v}".encode() for k, v in fields]])
    return gzip.compress(head + CRLF + CRLF + body + CRLF + CRLF, compresslevel=6, mtime=0)


def write_archives(records: DataFrame, folder: str) -> None:
    """One archive per partition under ``folder``, which the executors share.

    ``records``: ``page_id, uri, payload, payload_digest, record_type, refers_to,
    record`` (a unique text). A task writes under a name of its attempt and moves the
    finished file to the partition's name, so a repeated task replaces its file and
    an attempt that is lost leaves nothing that the reader lists.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, path = open_filesystem(folder)
        fs.create_dir(path, recursive=True)
        part = posixpath.join(path, f"_{task.partitionId():06d}-{task.taskAttemptId()}")
        n = 0
        with fs.open_output_stream(part) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    out.write(_record(row))
                    n += 1
        final = posixpath.join(path, f"part-{task.partitionId():06d}.warc.gz")
        if fs.get_file_info(final).type != pafs.FileType.NotFound:
            fs.delete_file(final)
        fs.move(part, final)
        yield pa.RecordBatch.from_pydict({"n": [n]})

    records.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def plan_records(
    pages: DataFrame,
    min_bytes: int = MIN_REVISIT_BYTES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    scratch: Scratch | None = None,
) -> DataFrame:
    """A record per row of ``pages``: responses, and revisits of equal payloads.

    Of equal payloads of at least ``min_bytes`` the row with the smallest page id is
    the response, null ids last, and one of several rows with that id. A null html is
    an empty payload, and everything below ``min_bytes`` a response of its own.

    Payloads meet by digest: one row per digest is aggregated, those that stand for
    several pages are written down and joined back. A payload that many pages share
    is a hot key of that join between plain tables, which adaptive execution splits.
    """
    scratch = scratch_for(pages, scratch)
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("uri"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = scratch.cut(rows, "payloads")
    place = F.struct(F.col("page_id").isNull().alias("void"), "page_id", "_row")
    shared = (
        rows.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select("payload_digest", F.col("_first.page_id").alias("_page"), F.col("_first._row").alias("_response"))
    )
    shared = scratch.cut(shared, "shared")
    joined = rows.join(shared, "payload_digest", "left")
    again = F.col("_response").isNotNull() & (F.col("_row") != F.col("_response"))
    return joined.select(
        "page_id", "uri", "payload", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_page")).alias("refers_to"),
        F.concat_ws("/", "payload_digest", F.col("_row").cast("string")).alias("record"),
    )


# Reading


def _fields(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.split(CRLF)[1:]:
        name, mark, value = line.partition(b":")
        if mark:
            found[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return found


class _Window:
    """A file read forward in pieces, from which earlier bytes can be let go."""

    def __init__(self, file, at: int):
        self.file, self.at, self.data = file, at, b""
        file.seek(at)

    def need(self, upto: int) -> bool:
        """Read until byte ``upto`` of the file is held; False if the file is shorter."""
        while self.at + len(self.data) < upto:
            more = self.file.read(max(READ_BYTES, upto - self.at - len(self.data)))
            if not more:
                return False
            self.data += more
        return True

    def skip_to(self, at: int) -> None:
        self.data, self.at = self.data[at - self.at :], at


def _header_at(window: _Window, at: int) -> tuple[dict[str, str], int] | None:
    """The WARC fields and the length of the header, if a record's member is at ``at``, however long its header."""
    inflate, text, end, place = zlib.decompressobj(wbits=31), b"", -1, at
    while end < 0:
        data = inflate.unconsumed_tail
        if not data:
            window.need(place + HEADER_BYTES)
            data = window.data[place - window.at : place - window.at + HEADER_BYTES]
            place += len(data)
        if not data:
            raise EOFError(f"the archive ends inside the header at byte {at}")
        seen = max(len(text) - 3, 0)
        try:
            text += inflate.decompress(data, max(len(text), HEADER_BYTES))
        except zlib.error:
            return None
        if not text.startswith(b"WARC/"):
            return None
        end = text.find(CRLF + CRLF, seen)
        if end < 0 and inflate.eof:
            return None
    fields = _fields(text[:end])
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    return fields, end + 4


def _member(window: _Window, at: int) -> tuple[bytes, int]:
    """The decoded member at ``at`` and the place after it."""
    inflate, parts, place = zlib.decompressobj(wbits=31), [], at
    while not inflate.eof:
        if not window.need(place + 1):
            raise EOFError(f"the archive ends inside the record at byte {at}")
        fresh = window.data[place - window.at :]
        parts.append(inflate.decompress(fresh))
        place += len(fresh)
    return b"".join(parts), place - len(inflate.unused_data)


def scan_range(file, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, body) of the records of an open file that start in [start, end).

    Three equal bytes inside compressed data may look like a magic number, so a hit
    counts only if a WARC header decodes there. After a record the scan goes on
    behind it, where the next one starts. A member that is no record is passed over.
    """
    window, at = _Window(file, start), start
    while at < end:
        window.need(at + READ_BYTES)
        hit = window.data.find(MAGIC, at - window.at)
        if hit < 0:
            held = window.at + len(window.data)
            if not window.need(held + 1):
                return
            at = max(at, held - len(MAGIC) + 1)
            window.skip_to(at)
            continue
        at = window.at + hit
        if at >= end:
            return
        window.skip_to(at)
        found = _header_at(window, at)
        if not found:
            at += 1
            continue
        fields, skip = found
        decoded, after = _member(window, at)
        yield at, fields, decoded[skip : skip + int(fields["content-length"])]
        at = after
        window.skip_to(at)


RECORD = (
    "file string, offset long, record_type string, uri string, page_id long, payload binary, "
    "payload_bytes long, payload_digest string, refers_to long"
)
#: Payload bytes that a task hands on at once.
BATCH_BYTES = 4 << 20


def read_archives(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the ``*.warc.gz`` files under ``folder``, one row each.

    Spark lists the files; every ``split_bytes`` of one are a range, and the ranges are dealt out by
    number, which adaptive execution does not undo. Length and digest
    of a response are taken of the payload read; a revisit has no payload and repeats
    what its header says of it. Empty files and folders give no rows; a file that
    ends inside a record is an error. Missing numbers are null.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
        .select("path", "length").filter("length > 0")
    )
    last = F.floor((F.col("length") - 1) / F.lit(split_bytes))
    ranges = files.select("path", F.explode(F.sequence(F.lit(0), last)).alias("i")).select(
        "path", (F.col("i") * split_bytes).alias("start")
    )

    def number(text: str | None):
        return int(text) if text and text.lstrip("-").isdigit() else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist()):
                fs, name = open_filesystem(path)
                with fs.open_input_file(name) as file:
                    for offset, fields, body in scan_range(file, start, start + split_bytes):
                        stored = fields["warc-type"] != "revisit"
                        digest = hashlib.sha256(body).hexdigest()
                        said = fields.get("warc-payload-digest", "").removeprefix("sha256:")
                        length = number(fields.get("warc-payload-length"))
                        rows.append({
                            "file": path, "offset": offset, "record_type": fields["warc-type"],
                            "uri": fields.get("warc-target-uri"), "page_id": number(fields.get("x-page-id")),
                            "payload": body if stored else None,
                            "payload_bytes": len(body) if stored else length,
                            "payload_digest": digest if stored else said,
                            "refers_to": number(fields.get("x-refers-to-page-id")),
                        })
                        size += len(body)
                        if size >= BATCH_BYTES or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([
        ("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("uri", pa.string()),
        ("page_id", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()),
    ])
    return dealt(ranges, "path", "start").mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, scratch: Scratch | None = None) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    scratch = scratch_for(pages, scratch)
    folder = f"{scratch.folder}/archives"
    write_archives(plan_records(pages, min_bytes, scratch=scratch), folder)
    return read_archives(pages.sparkSession, folder)
