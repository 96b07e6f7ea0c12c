"""Byte ranges of files, read by tasks."""

import posixpath
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file that one task reads at a time.
RANGE_BYTES = 32 << 20
#: Bytes that are read at once while a line end is looked for.
STEP_BYTES = 64 << 10

# Hadoop's names of file systems that are called otherwise here.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "wasbs": "abfss"}


def open_input(uri: str):
    """A file opened for reading at any place; a bare or ``file:`` path is local."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + uri[5:].lstrip("/"))
    scheme, mark, rest = uri.partition("://")
    if not mark:
        return pafs.LocalFileSystem().open_input_file(uri)
    fs, path = pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    return fs.open_input_file(path)


def base_name(path: str) -> str:
    return posixpath.basename(path)


def file_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, length`` of the files, from their listing."""
    if not paths:
        return spark.createDataFrame([], "path string, length long")
    return spark.read.format("binaryFile").load(paths).select("path", "length")


def dealt(rows: DataFrame, key: list[str], least_rows: int = 1) -> DataFrame:
    """Few small rows that stand for much work, dealt out by number.

    The number of tasks is given, so adaptive execution leaves them apart, and is bounded by
    a multiple of the cores only where a task then still has ``least_rows`` of them.
    """
    count = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(count, max(4 * cores, count // least_rows))), *key)


def line_start(file, at: int, limit: int) -> int | None:
    """The first place in (``at`` - 1, ``limit``] behind a line end that lies before ``limit``; None without one."""
    file.seek(at - 1)
    place = at - 1
    while place < limit:
        data = file.read(min(STEP_BYTES, limit - place))
        if not data:
            return None
        hit = data.find(b"\n")
        if hit >= 0:
            return place + hit + 1
        place += len(data)
    return None


def segment(file, first: int, start: int, end: int, length: int) -> tuple[int, int]:
    """The whole lines that start in [``start``, ``end``) of a file whose first line starts at ``first``.

    A range without a line end, inside a long line, has none of its own: both places are equal.
    The segments of neighbouring ranges meet.
    """
    low = start if start <= first else line_start(file, start, min(end - 1, length))
    if low is None or low >= length:
        return length, length
    if end >= length:
        return low, length
    return low, line_start(file, end, length) or length


def read_between(file, low: int, high: int) -> bytes:
    file.seek(low)
    return file.read(high - low)


def lines_on(file, at: int, size: int) -> Iterator[bytes]:
    """What follows ``at``, in growing pieces."""
    file.seek(at)
    while data := file.read(size):
        yield data
        size *= 2
