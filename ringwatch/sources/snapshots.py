"""Market snapshots: one JSON document per poll, token id -> quote."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.functions.text import token_symbol
from ringwatch.schemas import SNAPSHOT


def flatten_snapshots(polls: DataFrame, document: str = "document", poll_ts: str = "poll_ts") -> DataFrame:
    """One row per poll and token; missing numbers count as 0."""
    quotes = polls.select(
        F.col(poll_ts).alias("poll_ts"), F.explode(F.from_json(document, SNAPSHOT)).alias("token", "quote")
    )
    default_zero = lambda field: F.coalesce(F.col(f"quote.{field}"), F.lit(0.0))
    return quotes.select(
        "poll_ts",
        "token",
        token_symbol(F.col("token")).alias("symbol"),
        default_zero("usd").alias("price_usd"),
        default_zero("usd_24h_vol").alias("volume_24h_usd"),
        default_zero("usd_24h_change").alias("change_24h_pct"),
        F.col("quote.last_updated_at").alias("last_updated_at"),
    )
