"""Event sources: topics or files of JSON records, decoded and routed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.functions.times import parse_time
from ringwatch.schemas import EVENT, PRICE_TOPIC, SOCIAL_EVENT, SOCIAL_TOPIC


def kafka_options(servers: str, topics: str = f"{SOCIAL_TOPIC},{PRICE_TOPIC}") -> dict[str, str]:
    """Subscribe from the earliest offset, go on after data loss, refresh metadata every 5 s."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.metadata.max.age.ms": "5000",
    }


def read_topic_stream(spark: SparkSession, servers: str, topics: str | None = None) -> DataFrame:
    options = kafka_options(servers, topics) if topics else kafka_options(servers)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select("value", F.struct("timestamp", "topic", "partition", "offset").alias("arrival"))


def read_file_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The file twin of a topic: one JSON record per line, with where it comes from as ``arrival``."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    place = [f"_metadata.{c}" for c in ("file_modification_time", "file_path", "file_block_start")]
    return reader.load(folder).select("value", F.struct(*place).alias("arrival"))


def in_order_of_arrival(events: DataFrame, out: str) -> DataFrame:
    """A batch of ``events`` with the column ``out``, by which they sort as they stand in their source.

    ``arrival`` is the place in the source: topic, partition and offset, or file and block. The number
    behind it orders the rows of a block, which a task reads in order. So the order is that of the source
    however a repeated batch is split among tasks. Without ``arrival`` the number alone is the order.
    """
    number = F.monotonically_increasing_id().alias("number")
    return events.withColumn(out, F.struct("arrival", number) if "arrival" in events.columns else number)


def decode(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON records to event columns, parsed once; other columns are kept.

    A malformed record becomes a row of nulls: it belongs to its batch but to
    neither event kind.
    """
    others = [c for c in raw.columns if c != value]
    event = F.from_json(F.col(value).cast("string"), EVENT)
    return raw.select(*others, event.alias("e")).select(*others, "e.*")


def social(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == SOCIAL_EVENT)


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_time", parse_time(F.col("timestamp")))
