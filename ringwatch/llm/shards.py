"""Rendezvous sharding of stable keys over weighted shards. DataFrame functions only."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.llm.common import utf8_bytes
from ringwatch.session import Scratch, scratch_for

ROW_OVERHEAD = 8


def shard_score(key: Column, shard: int, weight: float = 1.0) -> Column:
    """``-weight / ln(u)`` with ``u`` uniform in (0, 1) by the key and the shard's number."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return F.lit(-float(weight)) / F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 53)))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of the highest score; a key's scores do not depend on the other shards.

    So a new shard only takes the keys on which it scores highest, and a removed one
    only gives its own away. Equal scores go to the lower number.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("at least one shard, all weights positive")
    scored = [
        F.struct(shard_score(key, i, w).alias("score"), F.lit(-i).alias("back"))
        for i, w in enumerate(weights)
    ]
    return (-F.array_max(F.array(*scored))["back"]).cast("int")


def assign_shards(
    docs: DataFrame,
    weights: list[float],
    grown: list[float] | None = None,
    key: str = "doc_id",
    text: str = "text",
    scratch: Scratch | None = None,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard`` per row of ``docs``.

    ``size`` is the UTF-8 length of the text plus 8; a null text has none and a null
    checksum. Null keys share one shard, as do rows that repeat a key. Slots run
    gapless from 0 within each shard. An empty table gives an empty result; other
    columns of ``docs`` are ignored.

    Slots are numbered in blocks of the key's hash, about the square root of the row
    count of them in each shard, so neither a shard nor a popular text is one task's
    work. Rows that repeat a key are spread by the task that read them.
    """
    scratch = scratch_for(docs, scratch)
    name = F.col(key).cast("bigint")
    wider = rendezvous(F.col("doc_id"), grown) if grown else F.lit(None).cast("int")
    placed = docs.select(
        name.alias("doc_id"),
        (utf8_bytes(F.col(text)) + ROW_OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).select(
        "*",
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        wider.alias("grown_shard"),
        F.xxhash64("doc_id", F.spark_partition_id()).alias("_spread"),
    )
    placed = scratch.cut(placed, "placed")
    blocks = max(1, math.isqrt(placed.count() // len(weights)))
    placed = placed.withColumn("_block", F.pmod("_spread", F.lit(blocks)))
    counts = placed.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("shard", "_block").orderBy("doc_id", "_spread")
    numbered = placed.withColumn("_place", F.row_number().over(inside) - 1)
    return numbered.join(scratch.cut(starts, "starts"), ["shard", "_block"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("_start") + F.col("_place")).cast("bigint").alias("slot"), "grown_shard",
    )
