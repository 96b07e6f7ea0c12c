"""Candle files: per-coin CSVs to price events."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.functions.prices import is_body_pump
from ringwatch.functions.text import file_symbol, resolved_symbol
from ringwatch.params import DEFAULTS
from ringwatch.schemas import PRICE_EVENT
from ringwatch.sources.csvfiles import merge, read_csv_files
from ringwatch.sources.ranges import RANGE_BYTES

# Accepted column names, and the event's source.
EXACT = {
    "open": ("open", "open_price"),
    "high": ("high", "high_price"),
    "low": ("low", "low_price"),
    "close": ("close", "close_price"),
}
CONTAINED = {"volume": ("volume",), "date": ("date", "time")}
SOURCE = "kaggle_ohlcv"
NUMBERS = ["open", "high", "low", "close", "volume"]


def column_name(name: str) -> str:
    return name.lower().strip().replace(" ", "_")


def aliases(columns: list[str]) -> dict[str, list[str]]:
    """Role -> matching columns, in column order."""
    roles = {role: [c for c in columns if c in names] for role, names in EXACT.items()}
    for role, parts in CONTAINED.items():
        roles[role] = [c for c in columns if any(p in c for p in parts)]
    return roles


def resolve(df: DataFrame) -> DataFrame:
    """One file group under the canonical names, its symbol resolved.

    Each group is resolved by its own header, so merged files with different
    headers all keep their values.
    """
    roles = aliases(df.columns)
    picked = [
        F.col(f"`{roles[role][0]}`").alias(role) for role in [*EXACT, *CONTAINED] if roles[role]
    ]
    file = F.col("_file")
    symbol = resolved_symbol(F.col("symbol"), file) if "symbol" in df.columns else file_symbol(file)
    return df.select(*picked, symbol.alias("symbol"), "_file")


def read_ohlcv(
    spark: SparkSession, files: list[str] | DataFrame, range_bytes: int = RANGE_BYTES
) -> DataFrame | None:
    """Candles as text under canonical names, or None when no file is readable."""
    frames = [resolve(df) for df in read_csv_files(spark, files, column_name, range_bytes=range_bytes)]
    return merge(frames) if frames else None


def to_candles(df: DataFrame, body_pct: float = DEFAULTS.body_pct, now: Column | None = None) -> DataFrame:
    """Price events with the body flag.

    An absent column counts as 0.0; an empty cell stays null; a row with a cell
    that is not a number is skipped. No date column: the current time.
    """
    kept = df
    for name in NUMBERS:
        if name in df.columns:
            kept = kept.filter(F.col(name).isNull() | F.col(name).try_cast("double").isNotNull())

    def value(name):
        return F.col(name).try_cast("double") if name in df.columns else F.lit(0.0)

    when = F.current_timestamp() if now is None else now
    symbol = F.col("symbol") if "symbol" in df.columns else F.lit("UNKNOWN")
    return kept.select(
        F.lit(PRICE_EVENT).alias("event_type"),
        symbol.alias("symbol"),
        *[value(name).alias(name) for name in NUMBERS],
        is_body_pump(value("open"), value("close"), body_pct).alias("pumping"),
        (F.col("date") if "date" in df.columns else when).cast("string").alias("timestamp"),
        F.lit(SOURCE).alias("source"),
    )
