"""Size statistics of the input data sets."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.functions.text import file_coin


def per_file(rows: DataFrame) -> DataFrame:
    """Rows and bytes of each file of a file-based DataFrame."""
    return (
        rows.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes"))
    )


def dataset_stats(files: DataFrame, dataset: str, header_lines: int = 0) -> DataFrame:
    """Number of files, rows and MB of one data set."""
    return files.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum(F.col("rows") - header_lines), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("bytes") / (1024 * 1024), F.lit(0.0)).alias("mb"),
    ).select(F.lit(dataset).alias("dataset"), "n_files", "n_rows", "mb")


def csv_stats(spark: SparkSession, paths: list[str], dataset: str) -> DataFrame:
    """Statistics of CSV files; rows are the lines after the header, as plain text.

    Files are counted from the listing, so one with nothing but a header counts as well.
    """
    listed = spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("bytes"))
    lines = per_file(spark.read.text(paths)).select("path", "rows")
    # Both name files as URIs, one with and one without an empty authority.
    plain = lambda df: df.withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    files = plain(listed).join(plain(lines), "path", "left")
    return dataset_stats(files.withColumn("rows", F.greatest(F.col("rows"), F.lit(1))).fillna({"rows": 1}), dataset, 1)


def coin_labels(spark: SparkSession, paths: list[str], n: int | None = None) -> DataFrame:
    """Labels of the price files in order, the first ``n`` if given."""
    names = [(i, p.rsplit("/", 1)[-1]) for i, p in enumerate(paths[:n])]
    return spark.createDataFrame(names, "position int, file string").select(
        "position", file_coin(F.col("file")).alias("coin")
    )


def combined(stats: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, stats)
