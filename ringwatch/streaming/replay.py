"""Replay of historical files as a stream of topic records.

The pace is set by ``files_per_trigger`` and the trigger of the query, not by sleeping.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ringwatch.params import DEFAULTS
from ringwatch.sinks.topics import topic_records
from ringwatch.sources import ohlcv, tweets


def stream_csv(
    spark: SparkSession, folder: str, columns: list[str], files_per_trigger: int = 1, multiline: bool = False
) -> DataFrame:
    """CSV files of one header as a stream of text columns, with ``_file``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("maxFilesPerTrigger", files_per_trigger)
    )
    return reader.csv(folder).select("*", F.col("_metadata.file_name").alias("_file"))


def replay_candles(files: DataFrame, body_pct: float = DEFAULTS.body_pct) -> DataFrame:
    """Price events of OHLCV rows, as keyed records. Symbols are resolved row by row."""
    named = files.toDF(*[c if c == "_file" else ohlcv.column_name(c) for c in files.columns])
    candles = ohlcv.to_candles(ohlcv.resolve(named), body_pct)
    return topic_records(candles, F.col("symbol"))


def replay_tweets(files: DataFrame) -> DataFrame:
    """Interaction events of posts, as keyed records; posts without a text column are an error."""
    named = files.toDF(*[c if c == "_file" else tweets.column_name(c) for c in files.columns])
    roles = tweets.infer_roles([c for c in named.columns if c != "_file"])
    if not roles["text"] or not roles["user"]:
        raise ValueError(f"no text or user column among {named.columns}")
    posts = named.select(
        F.col(roles["user"]).alias("user"),
        F.col(roles["text"]).alias("text"),
        (F.col(roles["date"]) if roles["date"] else F.current_timestamp()).cast("string").alias("date"),
    )
    return topic_records(tweets.tweets_to_interactions(posts).drop("position"), F.col("source_user"))


def read_records(lines: DataFrame) -> DataFrame:
    """``key`` and ``value`` of the lines of a file twin; other columns are kept."""
    others = [c for c in lines.columns if c != "value"]
    record = F.from_json("value", "key string, value string").alias("record")
    return lines.select(*others, record).select(*others, "record.*")


def write_records(records: DataFrame, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """The file twin of a topic: one JSON line ``{"key": ..., "value": ...}`` per record, each written exactly once."""
    line = F.to_json(F.struct("key", "value"), {"ignoreNullFields": "false"}).alias("value")
    writer = records.select(line).writeStream.format("text").option("path", folder)
    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
