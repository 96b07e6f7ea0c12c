"""Price functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringwatch.params import DEFAULTS


def number(value: Column) -> Column:
    """NaN orders above every number in Spark, so it is turned into null first."""
    return F.when(~F.isnan(value), value)


def body_pct(open_: Column, close: Column) -> Column:
    """Candle body relative to the open, in percent; 0 where it is undefined."""
    open_, close = number(open_), number(close)
    return F.coalesce(F.when(open_ > 0, F.abs(close - open_) / open_ * 100), F.lit(0.0))


def is_body_pump(open_: Column, close: Column, pct: float = DEFAULTS.body_pct) -> Column:
    return body_pct(open_, close) > pct


def poll_change_pct(price: Column, previous: Column) -> Column:
    """0 where the previous price is not a positive number; NaN prices give null."""
    price, previous = number(price), number(previous)
    return F.when(previous > 0, (price - previous) / previous * 100).otherwise(F.lit(0.0))


def is_spike(change: Column, pct: float = DEFAULTS.spike_pct) -> Column:
    """Inclusive, in both directions, on the unrounded change."""
    return F.coalesce(F.abs(number(change)) >= pct, F.lit(False))
