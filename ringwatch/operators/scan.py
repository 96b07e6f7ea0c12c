"""Ordered computations over long series: ranges of the order, and what is carried from one to the next."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.session import Scratch, scratch_for

BLOCK = "_block"


def in_blocks(df: DataFrame, by: list[str], order: list[str], scratch: Scratch) -> DataFrame:
    """``df`` cut into ranges of ``by`` and ``order``, numbered by ``_block`` in that order, and written down.

    The ranges are equally large whatever the type and the spread of the order column, so a series
    that holds most rows, or a time at which most of them fall, spreads over many. Rows that are equal in
    all of ``by`` and ``order`` stay together. Nulls come first.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *by, *order).withColumn(BLOCK, F.spark_partition_id().cast("bigint"))
    return scratch.cut(ranged, "blocks")


def blocks_before(by: list[str]):
    """The window over one row per block: those of the same series before it."""
    return Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def inside_block(by: list[str], order: list[str]):
    """The window over the rows of a block and series up to the current one."""
    return Window.partitionBy(*by, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def as_of(
    rows: DataFrame,
    markers: DataFrame,
    order: str,
    value: str,
    out: str,
    by: list[str] | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``rows`` with the column ``out``: ``value`` of the last marker of the same series at or before each row, or null.

    ``markers`` has ``order``, ``value`` and the columns ``by``, which name a series and may be null.
    Of markers at one place the greatest value counts. Rows and markers are put in one order, and the last
    marker is carried from range to range, so no pair of a row and a marker is ever formed.
    """
    scratch = scratch_for(rows, scratch)
    series = F.struct(*(by or [F.lit(0)])).alias("_series")
    held = rows.select(series, F.col(order).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(
        markers.schema[value].dataType).alias("_mark"), F.struct(*rows.columns).alias("_row"))
    marks = markers.select(series, F.col(order).cast(rows.schema[order].dataType).alias("_at"), F.lit(0).alias("_kind"), F.col(value).alias("_mark"),
                           F.lit(None).cast(held.schema["_row"].dataType).alias("_row"))
    place = ["_at", "_kind", "_mark"]
    both = in_blocks(held.unionByName(marks), ["_series"], place, scratch)
    last = both.filter("_kind = 0").groupBy("_series", BLOCK).agg(F.max_by("_mark", F.struct("_at", "_mark")).alias("_left"))
    blocks = both.groupBy("_series", BLOCK).agg(F.count(F.lit(1)).alias("_n")).join(last, ["_series", BLOCK], "left")
    carried = blocks.select("_series", BLOCK, F.last("_left", ignorenulls=True).over(blocks_before(["_series"])).alias("_carried"))
    seen = F.last(F.when(F.col("_kind") == 0, F.col("_mark")), ignorenulls=True).over(inside_block(["_series"], place))
    found = both.withColumn("_seen", seen).filter("_kind = 1").join(carried, ["_series", BLOCK])
    return found.select("_row.*", F.coalesce("_seen", "_carried").alias(out))


def running_sums(rows: DataFrame, by: list[str], order: list[str], columns: dict[str, Column], scratch: Scratch) -> DataFrame:
    """``rows`` with the running sum of each of ``columns`` within its series, in order, the row itself included."""
    flagged = in_blocks(rows.select("*", F.struct(*(by or [F.lit(0)])).alias("_series"), *[c.alias(n) for n, c in columns.items()]),
                        ["_series"], order, scratch)
    totals = flagged.groupBy("_series", BLOCK).agg(*[F.sum(n).alias(n) for n in columns])
    carried = totals.select("_series", BLOCK, *[
        F.coalesce(F.sum(n).over(blocks_before(["_series"])), F.lit(0)).alias(f"_{n}") for n in columns
    ])
    inside = inside_block(["_series"], order)
    return flagged.join(carried, ["_series", BLOCK]).select(
        *rows.columns, *[(F.sum(n).over(inside) + F.col(f"_{n}")).alias(n) for n in columns]
    )
