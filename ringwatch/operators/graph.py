"""Interaction graph of each batch: edges, links, degrees, stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.params import DEFAULTS
from ringwatch.schemas import STAR
from ringwatch.sources.events import social


def interaction_edges(events: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """Directed edges with both users present; self-loops and repeats stay.

    ``seq`` names the columns of arrival order, which must be a total one. One plain
    column is best: its minimum is hash-aggregated, that of several columns is sorted.
    """
    order = F.col(seq[0]) if len(seq) == 1 else F.struct(*seq)
    present = (F.length("source_user") > 0) & (F.length("target_user") > 0)
    return (
        social(events)
        .filter(present)
        .select(
            *keys,
            order.alias("seq"),
            F.col("source_user").alias("src"),
            F.col("target_user").alias("dst"),
        )
    )


def gate_edges(edges: DataFrame, keys: list[str], min_edges: int = DEFAULTS.min_edges) -> DataFrame:
    """Edges of the batches that have at least ``min_edges`` of them.

    The join runs against the batches that fail, a row each. A large batch passes, so it is a hot key on the
    left side alone, which adaptive execution splits.
    """
    failing = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < min_edges)
    return edges.join(failing.select(*keys), keys, "left_anti")


def compact_links(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct directed edges with multiplicity ``n`` and first appearance ``seq``.

    Everything the detectors need of the edges is in this table; it is the only
    aggregation over the raw events, with partial sums on the map side.
    """
    weight = F.sum("n") if "n" in edges.columns else F.count(F.lit(1))
    return edges.groupBy(*keys, "src", "dst").agg(weight.alias("n"), F.min("seq").alias("seq"))


def degrees(links: DataFrame, keys: list[str]) -> DataFrame:
    """Out- and in-degree per node in one shuffle; repeats count, a self-loop counts on both sides."""
    n = F.col("n") if "n" in links.columns else F.lit(1).cast("bigint")
    none = F.lit(0).cast("bigint")
    ends = F.array(
        F.struct(F.col("src").alias("node"), n.alias("out"), none.alias("in")),
        F.struct(F.col("dst").alias("node"), none.alias("out"), n.alias("in")),
    )
    return (
        links.select(*keys, F.explode(ends).alias("e"))
        .select(*keys, "e.*")
        .groupBy(*keys, "node")
        .agg(F.sum("out").alias("out_degree"), F.sum("in").alias("in_degree"))
    )


def undirected_edges(links: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct unordered pairs ``(a, b)`` with ``a <= b``; a self-loop is its own neighbour."""
    return links.select(
        *keys, F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    ).distinct()


def detect_stars(
    links: DataFrame,
    keys: list[str],
    min_degree: int = DEFAULTS.star_min_degree,
    degree_ratio: float = DEFAULTS.star_ratio,
) -> DataFrame:
    """Hubs whose out-degree is high both absolutely and against the in-degree."""
    ratio = F.col("out_degree") / (F.col("out_degree") + F.col("in_degree"))
    return (
        degrees(links, keys)
        .filter((F.col("out_degree") > 0) & (F.col("out_degree") >= min_degree))
        .filter(ratio >= degree_ratio)
        .select(
            *keys,
            F.lit(STAR).alias("alert_type"),
            F.lit("HIGH").alias("severity"),
            F.col("node").alias("hub_node"),
            "out_degree",
            F.round(ratio, 3).alias("out_ratio"),
        )
    )
