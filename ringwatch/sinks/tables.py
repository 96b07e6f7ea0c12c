"""Durable tables of the detection stream, written so that a repeated batch replaces itself.

A batch is a folder of its own. The folders of ``BLOCK`` batches that have all been followed are merged
into one file, so that a call reads a file per closed block and those of the open one, however
long the stream has run. Files are written under a new version and only then take the place of others; what a lost
driver leaves half done is never read.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Batches whose folders share a parent, and that are merged together.
BLOCK = 1000


class Folder:
    """A folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._class(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, inner: str = "") -> list[str]:
        place = self._class(f"{self.path}/{inner}".rstrip("/"))
        if not self._fs.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(place))

    def numbers(self, prefix: str, inner: str = "") -> list[int]:
        """The numbers of the folders ``prefix=number``."""
        found = [n.removeprefix(f"{prefix}=") for n in self.names(inner) if n.startswith(f"{prefix}=")]
        return sorted(int(n) for n in found if n.isdigit())

    def drop(self, inner: str) -> None:
        self._fs.delete(self._class(f"{self.path}/{inner}"), True)

    def versions(self, inner: str = "") -> list[int]:
        """Versions that were written to their end."""
        base = f"{inner}/" if inner else ""
        return [v for v in self.numbers("version", inner) if "_SUCCESS" in self.names(f"{base}version={v}")]

    def replace(self, df: DataFrame, inner: str = "") -> None:
        """Write ``df`` as the next version, then drop the earlier ones."""
        base = f"{inner}/" if inner else ""
        there = self.numbers("version", inner)
        version = there[-1] + 1 if there else 0
        draft = f"{base}_draft-{uuid.uuid4().hex}"
        df.coalesce(1).write.parquet(f"{self.path}/{draft}")
        self._fs.mkdirs(self._class(f"{self.path}/{inner}".rstrip("/")))
        self._fs.rename(self._class(f"{self.path}/{draft}"), self._class(f"{self.path}/{base}version={version}"))
        for old in there:
            self.drop(f"{base}version={old}")

    def latest(self, inner: str = "") -> str | None:
        found = self.versions(inner)
        return f"{self.path}/{f'{inner}/' if inner else ''}version={found[-1]}" if found else None


def _closed(spark: SparkSession, path: str) -> Folder:
    return Folder(spark, f"{path.rstrip('/')}_closed")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace what the table holds of one batch, also by nothing.

    A batch is a folder of its own that is overwritten whole, so a repeated batch
    leaves no row of an earlier attempt, even when it has no rows any more.
    """
    folder = f"{path.rstrip('/')}/block={batch_id // BLOCK}/batch_id={batch_id}"
    df.drop("batch_id", "block").write.mode("overwrite").parquet(folder)


def open_batches(spark: SparkSession, path: str, block: int) -> list[int]:
    return Folder(spark, path).numbers("batch_id", f"block={block}")


def _located(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    places = [T.StructField("block", T.LongType()), T.StructField("batch_id", T.LongType())]
    fields = [f for f in columns if f.name not in ("block", "batch_id")]
    schema = T.StructType([*fields, *places])
    blocks = Folder(spark, path).numbers("block")
    if not blocks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _merged(spark: SparkSession, path: str, columns: T.StructType, blocks: list[int]) -> DataFrame:
    """The merged rows of closed blocks, less those of batches that were written again since."""
    closed = _closed(spark, path)
    files = [closed.latest(f"block={b}") for b in blocks]
    fields = [f for f in columns if f.name not in ("block", "batch_id")]
    schema = T.StructType([*fields, T.StructField("batch_id", T.LongType())])
    if not any(files):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f for f in files if f])
    again = [n for b in blocks for n in open_batches(spark, path, b)]
    return rows.filter(~F.col("batch_id").isin(again)) if again else rows


def closed_blocks(spark: SparkSession, path: str) -> list[int]:
    closed = _closed(spark, path)
    return [b for b in closed.numbers("block") if closed.versions(f"block={b}")]


def close_blocks(spark: SparkSession, path: str, columns: T.StructType, before: int) -> list[int]:
    """Merge the open batches of all blocks before ``before``; the blocks that changed.

    A block that was closed already takes in the batches that were written again.
    """
    table = Folder(spark, path)
    done = [b for b in table.numbers("block") if b < before]
    for block in done:
        rows = _located(spark, path, columns).filter(F.col("block") == block).drop("block")
        whole = rows.unionByName(_merged(spark, path, columns, [block]))
        _closed(spark, path).replace(whole, f"block={block}")
        table.drop(f"block={block}")
    return done


def read_table(spark: SparkSession, path: str, columns: T.StructType, blocks: list[int] | None = None) -> DataFrame:
    """All batches of the table, or those of the given blocks, with their ``batch_id``."""
    rows = _located(spark, path, columns)
    if blocks is not None:
        rows = rows.filter(F.col("block").isin(blocks))
    closed = closed_blocks(spark, path)
    merged = _merged(spark, path, columns, [b for b in closed if blocks is None or b in blocks])
    return rows.drop("block").unionByName(merged)


def read_batch(spark: SparkSession, path: str, columns: T.StructType, batch_id: int) -> DataFrame:
    """One batch; only its folder, or the file of its block, is read."""
    block = batch_id // BLOCK
    here = (F.col("block") == block) & (F.col("batch_id") == batch_id)
    rows = _located(spark, path, columns).filter(here).drop("block")
    return rows.unionByName(_merged(spark, path, columns, [block]).filter(F.col("batch_id") == batch_id))
