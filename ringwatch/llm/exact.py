"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import kept_rows, row_keys, single_spaced
from ringwatch.session import Scratch, scratch_for

PREFIX_CHARS = 128
#: The bit map of surviving prefix groups: at most so many rows of 4 KB, which every task gets.
MAP_ROWS = 2048
ROW_BITS = 32768


def exact_duplicates(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Which rows share their normalised text, and which of them stays.

    Returns one row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``,
    ``kept`` and the ``carry`` columns, given as output name -> expression over
    ``docs``. Other columns of ``docs`` are ignored, whatever their names.

    Texts are equal when they are once every run of ASCII white space is one space;
    null counts as empty, so nulls and empty texts form one group. Of equal texts
    the row with the smallest id stays, null ids last; of rows that repeat an id
    exactly one stays. An empty table gives an empty result.

    The first scan takes only the length and a hash of the first characters. Rows
    whose length, or prefix among equal lengths, is unique are settled by it. The
    second scan hashes the whole text of the others, at any size: a row knows itself as one
    by a bit map of the surviving groups, 67 million bits and 8 MB at most, so no text moves. Of rows
    that a shared bit lets through, the hash is one that no other row has. A class that holds much of the
    table is one hot key of the last join, both sides of which are plain tables, so adaptive execution splits it.
    """
    scratch = scratch_for(docs, scratch)
    plain = docs.select(
        F.col(id_col).cast("bigint").alias("_id"), single_spaced(F.col(text)).alias("_text")
    )
    length = F.octet_length("_text").alias("_length")
    head = F.xxhash64(F.substring("_text", 1, PREFIX_CHARS)).alias("_head")

    heads = plain.select(length, head).groupBy("_length", "_head").agg(F.count(F.lit(1)).alias("_n"))
    heads = scratch.cut(heads, "heads")
    lengths = heads.groupBy("_length").agg(F.sum("_n").alias("_m")).filter("_m > 1").select("_length")
    open_heads = heads.filter("_n > 1").join(lengths, "_length", "left_semi").select("_length", "_head")
    open_heads = scratch.cut(open_heads, "open_heads")

    carried = [expression.alias(name) for name, expression in (carry or {}).items()]
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"), single_spaced(F.col(text)).alias("_text"), *carried
    ).select("*", length, head)
    rows = _marked(rows, open_heads)
    full = F.when(F.col("_open"), F.unhex(F.sha2("_text", 256)))
    names = list(carry or {})
    hashed = rows.select(
        "_id", F.monotonically_increasing_id().alias("_row"), full.alias("_full"), *names
    )
    hashed = scratch.cut(hashed, "hashed")

    # Null ids sort last, the row number settles repeated ids.
    place = F.struct(F.col("_id").isNull().alias("void"), "_id", "_row")
    groups = (
        hashed.filter(F.col("_full").isNotNull())
        .groupBy("_full")
        .agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_size"))
        .filter("_size > 1")
        .select("_full", F.col("_first._id").alias("_keep"), F.col("_first._row").alias("_keep_row"), "_size")
    )
    groups = scratch.cut(groups, "groups")
    shared = hashed.filter(F.col("_full").isNotNull()).join(groups, "_full", "left")
    alone = hashed.filter(F.col("_full").isNull())
    for name in ("_keep", "_keep_row", "_size"):
        alone = alone.withColumn(name, F.lit(None).cast("bigint"))
    single = F.col("_size").isNull()
    return shared.unionByName(alone).select(
        F.col("_id").alias("doc_id"),
        F.when(single, F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
        (single | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        *names,
    )


def _bit() -> Column:
    """The bit of a prefix group."""
    return F.pmod(F.xxhash64("_length", "_head"), F.lit(MAP_ROWS * ROW_BITS))


def _marked(rows: DataFrame, open_heads: DataFrame) -> DataFrame:
    """``rows`` with ``_open``: whether the bit of their prefix group is set by any of ``open_heads``."""
    at = open_heads.select(F.shiftright(_bit(), 15).alias("_map_row"), (_bit() % ROW_BITS).alias("_at"))
    bits = at.groupBy("_map_row").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    met = rows.join(F.broadcast(bits), F.shiftright(_bit(), 15) == F.col("_map_row"), "left")
    place = F.shiftright((_bit() % ROW_BITS).cast("int"), 3) + 1
    byte = F.conv(F.hex(F.substring("_bits", place, F.lit(1))), 16, 10).cast("int")
    is_open = F.coalesce(F.getbit(byte, (_bit() % 8).cast("int")) == 1, F.lit(False))
    return met.withColumn("_open", is_open).drop("_map_row", "_bits")


def drop_exact_duplicates(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", scratch: Scratch | None = None
) -> DataFrame:
    """``docs`` with one row of each class, all its columns unchanged."""
    scratch = scratch_for(docs, scratch)
    carry = dict(zip(("_key", "_more"), row_keys(docs)))
    return kept_rows(docs, exact_duplicates(docs, text, id_col, carry, scratch), scratch)
