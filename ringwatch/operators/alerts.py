"""Alert rows: union of detectors, enrichment by batch, confirmed alerts."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.batches import batch_summary, score_batches
from ringwatch.operators.graph import compact_links, detect_stars, interaction_edges
from ringwatch.operators.rings import SHOWN_NODES, detect_rings
from ringwatch.params import DEFAULTS, Params
from ringwatch.schemas import ALERT, CONFIRMED
from ringwatch.session import Scratch, scratch_for


BATCH = "_batch"


@dataclass(frozen=True)
class Detection:
    """Results of one detection run: a row per batch, and the alerts."""

    scored: DataFrame
    alerts: DataFrame


def as_alerts(df: DataFrame, keys: list[str]) -> DataFrame:
    """The alert schema after the keys; columns a kind of alert lacks are null."""
    return df.select(
        *keys,
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ALERT
        ],
    )


def enrich(
    found: DataFrame, scored: DataFrame, keys: list[str], detected_at: Column, params: Params = DEFAULTS
) -> DataFrame:
    """Alerts with the confidence and price state of their batch.

    The price state is that of the whole batch; symbols are not matched to the
    tokens of the edges. Join strategy and skew are left to adaptive execution:
    there is one row per batch on the right, but any number of batches.
    """
    context = scored.filter(F.col("edge_count") >= params.min_edges).select(
        *keys,
        "confidence",
        F.col("price_pumping").alias("price_corroborated"),
        "pumping_tokens",
        F.col("edge_count").alias("social_edge_count"),
        F.round("gt_bot_ratio", 3).alias("gt_bot_ratio"),
        detected_at.alias("detected_at"),
    )
    return as_alerts(found.join(context, keys), keys)


def confirmed(scored: DataFrame, keys: list[str], detected_at: Column) -> DataFrame:
    """One critical alert per batch with both a social alert and a pumping price."""
    both = scored.filter((F.col("alert_count") > 0) & F.col("price_pumping"))
    return as_alerts(
        both.select(
            *keys,
            F.lit(CONFIRMED).alias("alert_type"),
            F.lit("CRITICAL").alias("severity"),
            F.lit("CRITICAL").alias("confidence"),
            "pumping_tokens",
            F.col("edge_count").alias("social_edge_count"),
            detected_at.alias("detected_at"),
            F.col("alert_count").alias("social_alerts"),
        ),
        keys,
    )


def all_alerts(
    found: DataFrame,
    scored: DataFrame,
    keys: list[str],
    detected_at: Column | None = None,
    params: Params = DEFAULTS,
) -> DataFrame:
    when = F.current_timestamp() if detected_at is None else detected_at
    return enrich(found, scored, keys, when, params).unionByName(confirmed(scored, keys, when))


def detect(
    events: DataFrame,
    keys: list[str],
    seq: list[str],
    params: Params = DEFAULTS,
    detected_at: Column | None = None,
    rings: bool = True,
    scratch: Scratch | None = None,
    shown: int = SHOWN_NODES,
) -> Detection:
    """The whole pipeline over any number of batches.

    The events are read twice, once for the batch summary and once for the
    distinct links; the detectors work on the links alone. The keys travel as one
    struct, whose null fields compare as equal, so a batch with a null key is a batch
    like any other. Alerts list ``shown`` members of a ring; reports that need none take 0. Links, alerts and scores are written down where they are used
    more than once; the rounds of the ring detector need them as tables.
    """
    scratch = scratch_for(events, scratch)
    events = events.withColumn(BATCH, F.struct(*keys))
    links = compact_links(interaction_edges(events, [BATCH], seq), [BATCH])
    return detect_links(links, batch_summary(events, [BATCH]), params, detected_at, rings, scratch, shown)


def detect_links(
    links: DataFrame,
    summary: DataFrame,
    params: Params,
    detected_at: Column | None,
    rings: bool,
    scratch: Scratch,
    shown: int = SHOWN_NODES,
) -> Detection:
    """``detect`` from the distinct links and the summary of the batches, whose keys are the struct ``_batch``."""
    batch = [BATCH]
    links = scratch.cut(links, "links")
    found = detect_stars(links, batch, params.star_min_degree, params.star_ratio)
    if rings:
        dense = detect_rings(links, batch, params.ring_min_size, params.ring_density, scratch=scratch, shown=shown)
        found = found.unionByName(dense, allowMissingColumns=True)
    found = scratch.cut(found, "found")
    scored = scratch.cut(score_batches(summary, found, batch, params), "scored")
    scored = scored.select(f"{BATCH}.*", "*")
    alerts = all_alerts(found, scored, batch, detected_at, params)
    return Detection(scored.drop(BATCH), alerts.select(f"{BATCH}.*", *ALERT.fieldNames()))
