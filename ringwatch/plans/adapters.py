"""The test tables seen as market data."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.functions.times import week_of
from ringwatch.schemas import EVENT, PRICE_EVENT, SOCIAL_EVENT
from ringwatch.session import Scratch

#: Spark's own size of a file split.
SPLIT_BYTES = 128 << 20
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer files than there are cores, dealt out to all of them.

    A small file is one row group and so one task, however long its rows take. Files
    that Spark splits by itself are left alone: that is a matter of their size.
    """
    spark, files = df.sparkSession, df.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    if not 0 < len(files) < cores:
        return df
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0]
    return df.repartition(cores) if size < cores * SPLIT_BYTES else df


SOCIAL_KINDS = ["click", "view", "error"]
PRICE_KINDS = ["purchase", "signup"]


def market_events(spark: SparkSession, sf_dir: str, kinds: list[str] | None = None) -> DataFrame:
    """``events`` as interactions and candles, with ``event_id``, ``ts``, ``day`` and ``week``.

    ``kinds`` of the raw events are a filter that reaches the scan.
    """
    kind = F.col("event_type")
    is_social = kind.isin(SOCIAL_KINDS)
    is_price = kind.isin(PRICE_KINDS)
    raw = table(spark, sf_dir, "events")

    def user(value):
        return F.concat(F.lit("u"), value.cast("string"))

    columns = {
        "event_type": F.when(is_social, SOCIAL_EVENT).when(is_price, PRICE_EVENT),
        "source_user": F.when(is_social, user(F.col("user_id"))),
        "target_user": F.when(is_social, user(F.get_json_object("props", "$.k"))),
        "interaction_type": F.when(is_social, kind),
        "token_mentioned": F.lit(None).cast("string"),
        "is_bot": F.when(is_social, F.col("user_id") % 5 == 0),
        "pump_signal": F.when(is_social, (kind == "error") & (F.col("value") > 200)),
        "symbol": F.when(is_price, F.concat(F.lit("T"), (F.col("user_id") % 15).cast("string"))),
        "pumping": F.when(is_price, F.col("value") > 250),
        "timestamp": F.date_format("ts", TIME_FORMAT),
        "source": F.lit("events"),
    }
    return (raw.filter(kind.isin(kinds)) if kinds else raw).select(
        "event_id",
        "ts",
        F.col("ts").cast("date").alias("day"),
        week_of(F.col("ts")).alias("week"),
        *[columns[f.name].alias(f.name) for f in EVENT],
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON text, with their day."""
    events = market_events(spark, sf_dir)
    return events.select("day", F.to_json(F.struct(*EVENT.fieldNames())).alias("value"))


def _unit_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), (F.col("l_partkey") % 15).cast("string")).alias("symbol"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("px"),
        F.col("l_quantity").alias("quantity"),
        "l_shipdate",
        "l_orderkey",
        "l_linenumber",
    )


def monthly_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` unit prices as one candle per symbol and month, as CSV text columns."""
    place = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "px")
    candles = _unit_prices(spark, sf_dir).groupBy("symbol", "month").agg(
        F.min_by("px", place).alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", place).alias("close"),
        F.sum("quantity").alias("volume"),
    )
    return candles.select("symbol", F.col("month").cast("string").alias("date"), *candles.columns[2:])


def monthly_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean unit price per token and month, as if polled once a month."""
    return (
        _unit_prices(spark, sf_dir)
        .groupBy(F.col("symbol").alias("token"), F.col("month").alias("poll_ts"))
        .agg(F.round(F.avg("px"), 2).alias("price_usd"), F.sum("quantity").alias("volume"))
    )


def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per month: token -> quote. Quotes of low volume lack the volume."""
    quote = F.struct(
        F.col("price_usd").alias("usd"),
        F.when(F.col("volume") > 600, F.col("volume")).alias("usd_24h_vol"),
    )
    token = F.replace(F.lower("token"), F.lit("p"), F.lit("coin-"))
    quotes = F.collect_list(F.struct(token.alias("key"), quote.alias("value")))
    return (
        monthly_polls(spark, sf_dir)
        .groupBy("poll_ts")
        .agg(F.to_json(F.map_from_entries(quotes)).alias("document"))
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as posts; every third one opens with two mentions, less those whose label is null."""
    mentions = [F.coalesce(F.concat(F.lit("@"), F.col(c), F.lit(" ")), F.lit("")) for c in ("source", "lang")]
    opening = F.concat(*mentions)
    text = F.concat(F.when(F.col("doc_id") % 3 == 0, opening).otherwise(F.lit("")), F.col("text"))
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("source").alias("user"), text.alias("text"), F.lit("2024-01-01").alias("date")
    )


def _csv_files(frames: list[DataFrame], folder: str) -> DataFrame:
    """The frames written as CSV files of a header each, all cells quoted: ``path, length`` of the files."""
    spark = frames[0].sparkSession
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for i, df in enumerate(frames):
        df.write.options(header=True, escape='"', quoteAll=True, **keep).csv(f"{folder}/{i}")
    found = spark.read.format("binaryFile").options(pathGlobFilter="*.csv", recursiveFileLookup=True)
    return found.load(folder).select("path", "length")


def post_files(spark: SparkSession, sf_dir: str, scratch: Scratch) -> DataFrame:
    """The posts as CSV files of two headers, the day of each in one of four layouts."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 20000).cast("int"))
    layouts = ["yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm", "MMM d HH:mm:ss Z yyyy", "d MMM yyyy"]
    when = F.element_at(
        F.array(*[F.date_format(day, layout) for layout in layouts]), (F.shiftright("doc_id", 1) % 4 + 1).cast("int")
    )
    dated = posts(spark, sf_dir).withColumn("date", when)
    even = F.col("doc_id") % 2 == 0
    frames = [
        dated.filter(even).select(F.col("user").alias("User_Name"), "text", "date"),
        dated.filter(~even).select(
            F.col("date").alias("created"), F.lit("1").alias("likes"), F.col("text").alias("Content"), F.col("user").alias("author"),
        ),
    ]
    return _csv_files(frames, f"{scratch.folder}/posts")


def candle_files(spark: SparkSession, sf_dir: str, scratch: Scratch) -> DataFrame:
    """The candles as CSV files of two headers with other names and another order, days in two layouts."""
    candles = monthly_candles(spark, sf_dir)
    even = F.substring("symbol", 2, 5).cast("int") % 2 == 0
    frames = [
        candles.filter(even).toDF("Symbol", "Date", "Open", "High", "Low", "Close", "Volume"),
        candles.filter(~even).select(
            F.col("volume").alias("Volume 24h"), F.col("close").alias("Close Price"), F.col("open").alias("Open Price"),
            "high", "low", F.lower("symbol").alias("symbol"), F.date_format(F.col("date").cast("date"), "d.M.yyyy").alias("time"),
        ),
    ]
    return _csv_files(frames, f"{scratch.folder}/candles")
