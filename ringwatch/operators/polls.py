"""Price polls: change against the previous poll of the same token."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.functions.prices import is_spike, poll_change_pct
from ringwatch.operators.scan import BLOCK, blocks_before, in_blocks
from ringwatch.params import DEFAULTS
from ringwatch.session import Scratch, scratch_for


def poll_changes(
    polls: DataFrame,
    spike_pct: float = DEFAULTS.spike_pct,
    token: str = "token",
    order: str = "poll_ts",
    price: str = "price_usd",
    ties: list[str] | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Adds the previous price, the change in percent and the spike flag.

    The first poll of a token is compared with itself; a price of 0 is
    remembered. Polls are cut into equally large ranges of token and time, of any type; each takes
    the last price of the range before it, so a busy token, or a busy day, spreads over many tasks.
    Polls without a token are one token of their own, those without a time come
    first. ``ties`` orders polls of the same time, by price if not given.
    """
    scratch = scratch_for(polls, scratch)
    place = [order, *(ties or [price])]
    # Structs compare null fields as equal, so null tokens join as well.
    known = polls.withColumn(price, F.coalesce(F.col(price), F.lit(0.0))).select(
        "*", F.struct(F.col(token).alias("token")).alias("_token")
    )
    known = in_blocks(known, ["_token"], place, scratch)
    last = known.groupBy("_token", BLOCK).agg(F.max_by(price, F.struct(*place)).alias("_last"))
    carried = last.select("_token", BLOCK, F.last("_last").over(blocks_before(["_token"])).alias("_carried"))
    inside = Window.partitionBy("_token", BLOCK).orderBy(*place)
    previous = F.coalesce(F.lag(price).over(inside), F.col("_carried"), F.col(price))
    change = poll_change_pct(F.col(price), F.col("previous_price"))
    return (
        known.join(carried, ["_token", BLOCK])
        .withColumn("previous_price", previous)
        .select(
            *polls.columns,
            "previous_price",
            F.round(change, 4).alias("change_since_last_poll_pct"),
            is_spike(change, spike_pct).alias("pumping"),
        )
    )


# Fixed value of the live candle.
LIVE_SOURCE = "coingecko_live"


def poll_candles(changes: DataFrame) -> DataFrame:
    """Price events of the polls, as they go to the price topic."""
    return changes.select(
        F.lit("price_candle").alias("event_type"),
        "symbol",
        "price_usd",
        "volume_24h_usd",
        F.round("change_24h_pct", 4).alias("change_24h_pct"),
        F.col("change_since_last_poll_pct").alias("change_since_last_poll"),
        "change_since_last_poll_pct",
        "pumping",
        F.col("poll_ts").cast("string").alias("timestamp"),
        F.lit(LIVE_SOURCE).alias("source"),
    )
