"""Events as keyed JSON records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def topic_records(events: DataFrame, key: Column, columns: list[str] | None = None) -> DataFrame:
    """``key`` and ``value`` of each record; a missing key is empty, null fields are kept."""
    fields = F.struct(*(columns or events.columns))
    value = F.to_json(fields, {"ignoreNullFields": "false"})
    return events.select(F.coalesce(key.cast("string"), F.lit("")).alias("key"), value.alias("value"))


def write_topic(records: DataFrame, servers: str, topic: str) -> None:
    records.write.format("kafka").options(**topic_options(servers, topic)).save()


def topic_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}
