"""Per-batch summary, confidence score, outcome and status."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.params import DEFAULTS, Params
from ringwatch.schemas import PRICE_EVENT, RING, SOCIAL_EVENT, STAR


def _all(*conditions):
    """Conjunction in which null counts as false."""
    result = F.lit(True)
    for condition in conditions:
        result = result & F.coalesce(condition, F.lit(False))
    return result


def part_counts() -> list:
    """Counts of a part of a batch, named for ``summary_of_parts``; plain sums and maxima, so parts can be streamed."""
    social = F.col("event_type") == SOCIAL_EVENT
    pumping = _all(F.col("event_type") == PRICE_EVENT, F.col("pumping"))
    named = _all(F.length("source_user") > 0, F.length("target_user") > 0)
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(social).alias("_social"),
        F.count_if(F.col("event_type") == PRICE_EVENT).alias("_price"),
        F.count_if(_all(social) & named).alias("_edges"),
        F.count_if(_all(social, F.col("is_bot"))).alias("_bots"),
        F.max(pumping).alias("_pumping"),
        F.max(_all(social, F.col("pump_signal"))).alias("_truth"),
    ]


def pumping_symbol():
    """The symbol of a pumping price, null for all other events."""
    pumping = _all(F.col("event_type") == PRICE_EVENT, F.col("pumping"))
    return F.when(pumping & (F.length("symbol") > 0), F.col("symbol")).alias("_symbol")


def summary_of_parts(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per batch from parts of it, of which each symbol has one: ``_symbol`` and the ``part_counts``."""
    summary = parts.groupBy(*keys).agg(
        F.sum("_rows").alias("event_count"),
        F.sum("_social").alias("social_count"),
        F.sum("_price").alias("price_count"),
        F.sum("_edges").alias("edge_count"),
        F.sum("_bots").alias("bot_count"),
        F.max("_pumping").alias("price_pumping"),
        F.array_sort(F.collect_list("_symbol")).alias("pumping_tokens"),
        F.max("_truth").alias("ground_truth"),
    )
    ratio = F.when(F.col("social_count") > 0, F.col("bot_count") / F.col("social_count"))
    return summary.withColumn("gt_bot_ratio", F.coalesce(ratio, F.lit(0.0)))


def batch_summary(events: DataFrame, keys: list[str]) -> DataFrame:
    """One row per batch from a single scan of its events.

    Counts are first taken per batch and pumping symbol, where they combine map
    side in plain hash aggregation; only the distinct symbols of a batch then
    meet in its token list.
    """
    return summary_of_parts(events.groupBy(*keys, pumping_symbol()).agg(*part_counts()), keys)


def score_batches(
    summary: DataFrame, alerts: DataFrame, keys: list[str], params: Params = DEFAULTS
) -> DataFrame:
    """Alert counts, confidence and outcome of every batch, quiet ones included.

    Detectors are void in a batch with fewer than ``min_edges`` edges. Applying
    that gate here, on one row per batch, spares the edges a join.
    """
    counts = alerts.groupBy(*keys).agg(
        F.count_if(F.col("alert_type") == STAR).alias("_stars"),
        F.count_if(F.col("alert_type") == RING).alias("_rings"),
    )

    def gated(column):
        passes = F.col("edge_count") >= params.min_edges
        return F.coalesce(F.when(passes, F.col(column)), F.lit(0).cast("bigint"))

    scored = summary.join(counts, keys, "left").select(
        *summary.columns, gated("_stars").alias("star_count"), gated("_rings").alias("ring_count")
    )
    pumping = F.when(F.col("price_pumping"), 3).otherwise(0)
    scored = scored.withColumn("alert_count", F.col("star_count") + F.col("ring_count")).withColumn(
        "score",
        F.col("ring_count") * 3
        + F.col("star_count") * 2
        + pumping
        + F.floor(F.col("gt_bot_ratio") * 5).cast("bigint"),
    )
    level = (
        F.when(F.col("score") >= 8, "CRITICAL")
        .when(F.col("score") >= 5, "HIGH")
        .when(F.col("score") >= 2, "MEDIUM")
        .otherwise("LOW")
    )
    return scored.withColumn("confidence", level).withColumn(
        "persisted", (F.col("alert_count") > 0) | F.col("price_pumping")
    )


def batch_outcomes(scored: DataFrame, keys: list[str], carry: Sequence[str] = ()) -> DataFrame:
    """Confusion outcome per batch: TP, FP, FN, or TN; ``carry`` names further columns to keep."""
    detected = F.col("alert_count") > 0
    outcome = (
        F.when(F.col("ground_truth") & detected, "TP")
        .when(detected, "FP")
        .when(F.col("ground_truth"), "FN")
        .otherwise("TN")
    )
    return scored.select(
        *keys, "ground_truth", detected.alias("detected"), outcome.alias("outcome"), "persisted", *carry
    )


def batch_status(scored: DataFrame, quality: DataFrame, keys: list[str]) -> DataFrame:
    """The status line of each batch, opened by its key, with running quality to two digits.

    A number is written with four digits at least, as the batches of a stream have.
    """
    kinds = dict(scored.dtypes)
    label = [
        F.format_string("%04d", c) if kinds[c] in ("int", "bigint") else F.col(c).cast("string") for c in keys
    ]
    line = F.format_string(
        "[Batch %s] %s | social=%d price=%d | alerts=%d conf=%s | P=%.2f R=%.2f F1=%.2f",
        F.concat_ws(" ", *label),
        F.when(F.col("alert_count") > 0, "[ANOMALY]").otherwise("[CLEAN]"),
        "social_count",
        "price_count",
        "alert_count",
        "confidence",
        "precision",
        "recall",
        "f1_score",
    )
    # As a struct the keys match where they are null, too.
    key = F.struct(*keys).alias("_key")
    running = quality.select(key, "precision", "recall", "f1_score")
    return scored.select("*", key).join(running, "_key").select(*keys, line.alias("status"), "persisted")
