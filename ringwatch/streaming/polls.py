"""Price changes on a stream of polls in event time: keyed state, and timers that close blocks of time."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ringwatch.functions.prices import is_spike, poll_change_pct
from ringwatch.params import DEFAULTS

#: The state store that keyed state needs; a session setting.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_OUT = T.StructType([
    T.StructField("token", T.StringType()), T.StructField("poll_ts", T.TimestampType()),
    T.StructField("price_usd", T.DoubleType()), T.StructField("previous_price", T.DoubleType()),
])


class _Held(StatefulProcessor):
    """Polls of one token wait in blocks of time until the watermark passes the end of their block.

    A block is held in pieces as they came, and a timer at its end sorts it and hands it on with the last price of
    the block before. So a task has the polls of one token and block in memory, however busy the token is.
    """

    def __init__(self, block_ms: int, forget_ms: int | None):
        self.block_ms, self.forget_ms = block_ms, forget_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.pieces = handle.getMapState("pieces", "block long, piece int", "micros array<long>, prices array<double>")
        self.sizes = handle.getMapState("sizes", "block long", "pieces int")
        self.last = handle.getValueState("last", "price double, at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for polls in rows:
            micros = polls["poll_ts"].astype("datetime64[us]").astype("int64")
            prices = polls["price_usd"].fillna(0.0)
            for block, part in micros.groupby(micros // (1000 * self.block_ms)):
                count = self.sizes.getValue((block,))[0] if self.sizes.containsKey((block,)) else 0
                if not count:
                    self.handle.registerTimer((int(block) + 1) * self.block_ms)
                self.pieces.updateValue((block, count), (part.tolist(), prices[part.index].tolist()))
                self.sizes.updateValue((block,), (count + 1,))
        yield pd.DataFrame(columns=_OUT.fieldNames())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        block = at // self.block_ms - 1
        if not self.sizes.containsKey((block,)):
            if self.last.exists() and self.last.get()[1] + self.forget_ms <= at:
                self.last.clear()
            return
        pieces = [self.pieces.getValue((block, i)) for i in range(self.sizes.getValue((block,))[0])]
        polls = pd.DataFrame({
            "micros": [m for piece in pieces for m in piece[0]], "price_usd": [p for piece in pieces for p in piece[1]],
        }).sort_values(["micros", "price_usd"], kind="stable", ignore_index=True)
        first = self.last.get()[0] if self.last.exists() else polls["price_usd"].iloc[0]
        self.last.update((float(polls["price_usd"].iloc[-1]), int(at)))
        for i in range(len(pieces)):
            self.pieces.removeKey((block, i))
        self.sizes.removeKey((block,))
        if self.forget_ms:
            self.handle.registerTimer(int(at) + self.forget_ms)
        yield pd.DataFrame({
            "token": key[0], "poll_ts": polls["micros"].astype("datetime64[us]"), "price_usd": polls["price_usd"],
            "previous_price": polls["price_usd"].shift(1, fill_value=first),
        })

    def close(self) -> None:
        pass


def ordered_poll_changes(
    polls: DataFrame,
    delay: str,
    spike_pct: float = DEFAULTS.spike_pct,
    block_seconds: int = 60,
    forget_seconds: int | None = None,
) -> DataFrame:
    """``poll_changes`` on a stream of ``token, poll_ts, price_usd``, whatever the order of arrival.

    A poll is handed on once the watermark, ``delay`` behind the latest poll, has passed its block of
    ``block_seconds``; by then all polls before it are known, so the result equals that of the
    batch form. Polls behind the watermark are dropped, as Spark counts in its query progress. Polls without
    a time are dropped, those without a token are one token of their own. With
    ``forget_seconds`` (a multiple of the block) the last price of a token is let go when so much time has passed
    without a poll, and the next poll counts as its first. The session needs the settings ``STATE_STORE``.
    """
    if forget_seconds is not None and (forget_seconds <= 0 or forget_seconds % block_seconds):
        raise ValueError("forget_seconds must be a multiple of block_seconds")
    rows = polls.select(
        "token", F.col("poll_ts").cast("timestamp").alias("poll_ts"), F.col("price_usd").cast("double").alias("price_usd")
    ).filter("poll_ts IS NOT NULL")
    held = _Held(1000 * block_seconds, None if forget_seconds is None else 1000 * forget_seconds)
    followed = rows.withWatermark("poll_ts", delay).groupBy("token").transformWithStateInPandas(
        statefulProcessor=held, outputStructType=_OUT, outputMode="Append", timeMode="EventTime"
    )
    change = poll_change_pct(F.col("price_usd"), F.col("previous_price"))
    return followed.select(
        "*", F.round(change, 4).alias("change_since_last_poll_pct"), is_spike(change, spike_pct).alias("pumping")
    )
