"""Price spikes on a stream of polls: the last price of each token is state."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ringwatch.functions.prices import is_spike, poll_change_pct
from ringwatch.params import DEFAULTS


def _with_previous(key: tuple, polls: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Polls of one token in time order, each with the price before it."""
    batch = pd.concat(polls).sort_values(["poll_ts", "price_usd"], kind="stable", na_position="first")
    known = batch["price_usd"].fillna(0.0)
    first = state.get[0] if state.exists else known.iloc[0]
    state.update((float(known.iloc[-1]),))
    yield batch.assign(price_usd=known, previous_price=known.shift(1, fill_value=first))


def streaming_poll_changes(polls: DataFrame, spike_pct: float = DEFAULTS.spike_pct) -> DataFrame:
    """``poll_changes`` on a stream of ``token, poll_ts, price_usd``.

    Within a micro-batch polls are taken in time order; a poll that comes in a later
    batch is compared with the last price seen, whatever its time.
    """
    rows = polls.select("token", "poll_ts", F.col("price_usd").cast("double").alias("price_usd"))
    kind = dict(rows.dtypes)["poll_ts"]
    followed = rows.groupBy("token").applyInPandasWithState(
        _with_previous,
        f"token string, poll_ts {kind}, price_usd double, previous_price double",
        "price double",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    change = poll_change_pct(F.col("price_usd"), F.col("previous_price"))
    return followed.select(
        "*",
        F.round(change, 4).alias("change_since_last_poll_pct"),
        is_spike(change, spike_pct).alias("pumping"),
    )
