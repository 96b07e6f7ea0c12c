"""CSV folders whose files may differ in their columns, split among tasks although cells may hold line ends.

A file is cut into byte ranges. Whether a range begins inside a quoted cell is not known from it
alone, so a first job finds, for both cases, in which of them its last line ends. Composed in the order
of the ranges these transfers tell where each one really begins, and a second job reads the records
that start in it.
"""

import csv
import logging
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringwatch.session import Scratch
from ringwatch.sources.ranges import (
    RANGE_BYTES, base_name, dealt, file_table, lines_on, open_input, read_between, segment,
)

log = logging.getLogger(__name__)

# Cell texts that stand for a missing value.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
BAD_LINE = "_bad_line"
MARK = b"\xef\xbb\xbf"
#: Bytes read of a file to find its header; a longer header is read on.
HEADER_BYTES = 64 << 10
#: A record beyond this is an error: a quote that is never closed takes in the rest of its file.
MOST_RECORD_BYTES = 256 << 20
#: Bytes of records that a task hands on at once.
BATCH_BYTES = 4 << 20


def list_inputs(spark: SparkSession, folder: str, single: str | None = None) -> list[str]:
    """The folder's ``*.csv`` files in name order, else the one merged file, else none.

    Files without a byte are not listed, as Spark reads nothing from them.
    """

    def names(path: str, **options: str) -> list[str]:
        try:
            found = spark.read.format("binaryFile").options(**options).load(path).select("path")
            return sorted(r.path for r in found.toLocalIterator())
        except AnalysisException:
            return []

    return names(folder, pathGlobFilter="*.csv") or (names(single) if single else [])


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, length`` of the folder's ``*.csv`` files; no name reaches the driver's Python."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path", "length")


# Quotes

_OPENS = re.compile(rb'[,\n]"')
_CLOSES = re.compile(rb'(?:[^"]++|"")*+"')


def quoted_spans(data: bytes, inside: bool) -> tuple[list[tuple[int, int]], bool]:
    """The quoted stretches of whole lines, and whether the last one is still open at the end.

    ``inside`` says that the first byte stands in a quoted cell. A quote opens a cell only as its first
    character; a doubled one is text; what follows the closing quote of a cell is text without quotes.
    """
    spans, begin, at = [], 0, 0
    opened = inside
    if not inside and data[:1] == b'"':
        opened, at = True, 1
    while True:
        if opened:
            closing = _CLOSES.match(data, at)
            if not closing:
                return [*spans, (begin, len(data))], True
            at = closing.end()
            spans.append((begin, at))
        opening = _OPENS.search(data, at)
        if not opening:
            return spans, False
        opened, begin, at = True, opening.end() - 1, opening.end()


def record_ends(data: bytes, inside: bool) -> tuple[np.ndarray, bool]:
    """The places of the line ends that end records, and whether a quoted cell is open at the end."""
    spans, opened = quoted_spans(data, inside)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    if spans and len(ends):
        bounds = np.array(spans)
        span = np.searchsorted(bounds[:, 0], ends, side="right") - 1
        ends = ends[(span < 0) | (ends >= bounds[np.maximum(span, 0), 1])]
    return ends, opened


def _text(record: bytes) -> str:
    """A record without its line end; bytes that are no UTF-8 are left out."""
    return record.rstrip(b"\r\n").decode("utf-8", "ignore")


# Headers


def _header(file, length: int) -> tuple[int, str]:
    """Where the records begin, and the first line that is not blank."""
    data, at = b"", 0
    while True:
        data += read_between(file, len(data), min(length, max(2 * len(data), HEADER_BYTES)))
        start = len(MARK) if data.startswith(MARK) else 0
        body = data[start:]
        ends, _ = record_ends(body, False)
        for end in [*ends.tolist(), *([len(body)] if len(data) == length else [])]:
            line = _text(body[at : end + 1])
            at = end + 1
            if line.strip():
                return min(start + at, length), line
        if len(data) == length:
            return length, ""
        at = 0


def headers(files: DataFrame) -> DataFrame:
    """``path, length, body, header`` of files ``path, length``: where the records begin, and the header line.

    Tasks read the first 64 KiB of each file, and more of one only as long as its header has not ended.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                with open_input(row["path"]) as file:
                    row["body"], row["header"] = _header(file, row["length"])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("body", pa.int64()), ("header", pa.string())])
    return dealt(files, ["path"], 64).mapInArrow(read, "path string, length long, body long, header string")


# Ranges


def byte_ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    """``path, length, body, part, start``: a row per ``range_bytes`` of what follows the header."""
    last = F.floor((F.col("length") - F.col("body") - 1) / F.lit(range_bytes))
    return files.filter("length > body").select(
        "path", "length", "body", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("part")
    ).withColumn("start", F.col("body") + F.col("part") * range_bytes)


def _lines(row: dict, range_bytes: int) -> Iterator[tuple]:
    """(open file, place, bytes) of the lines of a range, if any start there."""
    with open_input(row["path"]) as file:
        low, high = segment(file, row["body"], row["start"], row["start"] + range_bytes, row["length"])
        if low < high:
            yield file, low, read_between(file, low, high)


def quote_transfers(ranges: DataFrame, range_bytes: int) -> DataFrame:
    """``path, part, from_outside, from_inside``: whether a range ends inside a quoted cell, for both beginnings."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                ends = (False, True)
                for _, _, data in _lines(row, range_bytes):
                    if b'"' in data:
                        ends = quoted_spans(data, False)[1], quoted_spans(data, True)[1]
                rows.append({"path": row["path"], "part": row["part"], "from_outside": ends[0], "from_inside": ends[1]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([
        ("path", pa.string()), ("part", pa.int64()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_())
    ])
    return dealt(ranges, ["path", "part"]).mapInArrow(
        scan, "path string, part long, from_outside boolean, from_inside boolean"
    )


def entry_states(transfers: DataFrame) -> DataFrame:
    """``path, part, inside``: whether a range begins inside a quoted cell, by composing all transfers before it.

    A transfer keeps the state, turns it round, or forgets it. So the state is what the last forgetting
    range before left, turned round once for every turning range since. A file has one row per range.
    """
    before = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    upto = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    counted = transfers.withColumn("_turns", F.sum(turns).over(upto))
    forgets = F.when(F.col("from_outside") == F.col("from_inside"), F.struct("from_outside", "_turns"))
    last = F.last(forgets, ignorenulls=True).over(before)
    since = F.coalesce(F.sum(turns).over(before), F.lit(0)) - F.coalesce(last["_turns"], F.lit(0))
    left = F.coalesce(last["from_outside"], F.lit(False)).cast("int")
    return counted.select("path", "part", ((left + since) % 2 == 1).alias("inside"))


RECORD = "path string, offset long, record string"


def csv_records(files: DataFrame, scratch: Scratch, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``RECORD``: every record of files ``path, length, body`` that is not blank, with its place in the file.

    The transfers are written down, a row per range; the records are read when the result is.
    A task holds one range and the record that runs over its end.
    """
    ranges = byte_ranges(files, range_bytes)
    transfers = scratch.cut(quote_transfers(ranges, range_bytes), "transfers")
    entered = ranges.join(entry_states(transfers), ["path", "part"])

    def batches_of(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
        paths, offsets, records = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(paths), pa.array(offsets), pa.array(records)], names=["path", "offset", "record"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                for file, place, data in _lines(row, range_bytes):
                    for at, record in _records(file, place, data, row["inside"]):
                        if record.strip():
                            rows.append((row["path"], at, record))
                            size += len(record)
                        if size >= BATCH_BYTES or len(rows) >= 10_000:
                            yield batches_of(rows)
                            rows, size = [], 0
        if rows:
            yield batches_of(rows)

    return dealt(entered, ["path", "part"]).mapInArrow(read, RECORD)


def _records(file, place: int, data: bytes, inside: bool) -> Iterator[tuple[int, str]]:
    """(place, text) of the records that start in the lines ``data``, which stand at ``place`` of the file."""
    ends, _ = record_ends(data, inside)
    if inside:
        if not len(ends):
            return
        at, ends = int(ends[0]) + 1, ends[1:]
    else:
        at = 0
    for end in ends.tolist():
        yield place + at, _text(data[at : end + 1])
        at = end + 1
    if at < len(data):
        yield place + at, _text(_finished(file, data[at:], place + len(data)))


def _finished(file, begun: bytes, at: int) -> bytes:
    """A record with what stands of it after ``at``; without a closing quote, all that follows."""
    for more in lines_on(file, at, 1 << 20):
        begun += more
        ends, _ = record_ends(begun, False)
        if len(ends):
            return begun[: int(ends[0]) + 1]
        if len(begun) > MOST_RECORD_BYTES:
            raise ValueError(f"a record of over {MOST_RECORD_BYTES} bytes ends after byte {at}: a quote may be open")
    return begun


# Columns


def unique(names: list[str]) -> list[str]:
    """Names with a running number on repeats."""
    seen: dict[str, int] = {}
    result = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        result.append(name if seen[name] == 1 else f"{name}.{seen[name] - 1}")
    return result


def read_csv_files(
    spark: SparkSession,
    files: list[str] | DataFrame,
    rename: Callable[[str], str],
    drop_malformed: bool = False,
    range_bytes: int = RANGE_BYTES,
    scratch: Scratch | None = None,
) -> list[DataFrame]:
    """One DataFrame of text columns per distinct header, with ``_file``, ``_path`` and ``_offset``.

    ``files`` are paths, or a table ``path, length`` as of ``list_files``. Only distinct headers reach the
    driver. Files without a header line are skipped with a warning. Quoted cells may hold line
    ends; every file is split among tasks all the same. ``_offset`` is the byte at which a row's
    record starts, which together with the path names the row however the files are read.
    """
    table = file_table(spark, files) if isinstance(files, list) else files
    scratch = scratch or Scratch(spark)
    described = scratch.cut(headers(table.filter("length > 0")), "headers")
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in described.groupBy("header").agg(F.min("path").alias("path")).orderBy("path").collect():
        cells = next(csv.reader([row.header]), [])
        if not any(cells):
            log.warning("skipping %s and files like it: no header", base_name(row.path))
            continue
        groups.setdefault(tuple(unique([rename(c) for c in cells])), []).append(row.header)
    return [
        _cells(csv_records(described.filter(F.col("header").isin(lines)), scratch, range_bytes), columns, drop_malformed)
        for columns, lines in groups.items()
    ]


def _cells(records: DataFrame, columns: tuple[str, ...], drop_malformed: bool) -> DataFrame:
    """``drop_malformed`` drops records of another number of cells than the header has.

    The parser keeps such a record's text in a column of its own.
    """
    names = [f"c{i}" for i in range(len(columns))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, BAD_LINE]])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    parsed = records.select("path", "offset", F.from_csv("record", F.lit(schema.toDDL()), options).alias("row"))
    if drop_malformed:
        parsed = parsed.filter(F.col(f"row.{BAD_LINE}").isNull())
    cells = []
    for name, column in zip(names, columns):
        cell = F.col(f"row.{name}")
        cells.append(F.when(~cell.isin(MISSING), cell).alias(column))
    file = F.element_at(F.split("path", "/"), -1).alias("_file")
    return parsed.select(*cells, file, F.col("path").alias("_path"), F.col("offset").alias("_offset"))


def row_name(df: DataFrame) -> Column:
    """A name for each row by where it stands, whoever reads it: file and byte."""
    return F.concat_ws(":", F.col("_file"), F.col("_offset").cast("string"))


def merge(frames: list[DataFrame]) -> DataFrame:
    """All rows under the union of the columns."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
