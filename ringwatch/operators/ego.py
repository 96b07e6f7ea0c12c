"""Ego-network density by triangle counting.

The ego network of a node with k neighbours has N = k + 1 nodes and E = k + T
edges, T being the triangles through the node. Triangles are found on edges
directed from lower to higher degree, which bounds the joined paths by m^1.5
(Chiba & Nishizeki 1985; Suri & Vassilvitskii 2011) however large a hub is.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.params import DEFAULTS
from ringwatch.session import Scratch, scratch_for

# A node's share of a join is split into one part per this many neighbours.
SPLIT = 20_000


def _possible(k: Column) -> Column:
    return (k + 1) * k / 2


def both_ends(pairs: DataFrame, keys: list[str], *payload: tuple[str, Column, Column]) -> DataFrame:
    """Each pair seen from either end: ``node``, plus one column per payload."""
    sides = [
        F.struct(F.col(end).alias("node"), *[cols[i].alias(name) for name, *cols in payload])
        for i, end in enumerate(("a", "b"))
    ]
    return pairs.select(*keys, F.explode(F.array(*sides)).alias("e")).select(*keys, "e.*")


def with_degrees(pairs: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """Pairs without loops, each with the neighbour counts ``ka`` and ``kb`` of its ends.

    The counts are written down first: a join of plain tables is one whose hot keys
    adaptive execution can split, and a hub is the key of all its pairs.
    """
    proper = pairs.filter(F.col("a") != F.col("b"))
    k = both_ends(proper, keys).groupBy(*keys, "node").agg(F.count(F.lit(1)).alias("k"))
    k = scratch.cut(k, "degrees")
    ka = k.select(*keys, F.col("node").alias("a"), F.col("k").alias("ka"))
    kb = k.select(*keys, F.col("node").alias("b"), F.col("k").alias("kb"))
    return proper.join(ka, [*keys, "a"]).join(kb, [*keys, "b"])


def density_candidates(
    edges: DataFrame, keys: list[str], min_size: int, density: float | None
) -> DataFrame:
    """Nodes whose ego network may still reach the density, with their ``k``.

    A neighbour v takes part in at most min(deg v - 1, k - 1) triangles of the
    node, and each triangle has two of its neighbours, so half the sum over
    neighbours bounds T. No qualifying node is lost.
    """
    ka, kb = F.col("ka"), F.col("kb")
    nodes = (
        both_ends(
            edges,
            keys,
            ("k", ka, kb),
            ("reach", F.least(kb - 1, ka - 1), F.least(ka - 1, kb - 1)),
        )
        .groupBy(*keys, "node")
        .agg(F.max("k").alias("k"), F.sum("reach").alias("reach"))
        .filter(F.col("k") + 1 >= min_size)
    )
    if density is not None:
        most = F.col("k") + F.floor(F.col("reach") / 2)
        nodes = nodes.filter(most / _possible(F.col("k")) >= density)
    return nodes.select(*keys, "node", "k")


def _around(edges: DataFrame, seeds: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """Edges with both ends among the seeds and their neighbours: all edges of seed triangles."""

    def flagged(df, end):
        flag = seeds.select(*keys, F.col("node").alias(end), F.lit(True).alias(f"_{end}"))
        return df.join(flag, [*keys, end], "left")

    touching = flagged(flagged(edges, "a"), "b").filter(
        F.col("_a").isNotNull() | F.col("_b").isNotNull()
    )
    near = scratch.cut(both_ends(touching, keys).distinct(), "near_nodes")
    for end in ("a", "b"):
        edges = edges.join(near.withColumnRenamed("node", end), [*keys, end], "left_semi")
    return edges


def triangles(edges: DataFrame, keys: list[str], split: int = SPLIT) -> DataFrame:
    """Every triangle once, as ``(u, v, w)`` in increasing (degree, id) order.

    ``edges`` carries ``ka`` and ``kb``. Both joins split the work of a large
    node into parts: one side is cut by a hash into ceil(degree / split) parts
    and the other repeated once per part, so no task holds a whole hot group.
    """
    low_first = (F.col("ka") < F.col("kb")) | ((F.col("ka") == F.col("kb")) & (F.col("a") < F.col("b")))

    def pick(first, second):
        return F.when(low_first, F.col(first)).otherwise(F.col(second))

    directed = edges.filter((F.col("ka") > 1) & (F.col("kb") > 1)).select(
        *keys,
        pick("a", "b").alias("u"),
        pick("b", "a").alias("v"),
        pick("ka", "kb").alias("ku"),
        pick("kb", "ka").alias("kv"),
    )

    def parts(degree):
        return F.ceil(F.col(degree) / F.lit(split)).cast("int")

    def part_of(node, degree):
        return F.pmod(F.hash(node), parts(degree)).alias("_part")

    def every_part(degree):
        return F.explode(F.sequence(F.lit(0), parts(degree) - 1)).alias("_part")

    first = directed.select(*keys, "u", "v", "kv", part_of("v", "ku"))
    second = directed.select(
        *keys, "u", F.col("v").alias("w"), F.col("kv").alias("kw"), every_part("ku")
    )
    in_order = (F.col("kv") < F.col("kw")) | ((F.col("kv") == F.col("kw")) & (F.col("v") < F.col("w")))
    paths = (
        first.join(second, [*keys, "u", "_part"])
        .filter(in_order)
        .select(*keys, "u", "v", "w", part_of("u", "kv"))
    )
    closing = directed.select(
        *keys, F.col("u").alias("v"), F.col("v").alias("w"), every_part("ku")
    )
    return paths.join(closing, [*keys, "v", "w", "_part"]).select(*keys, "u", "v", "w")


def ego_density(
    pairs: DataFrame,
    keys: list[str],
    min_size: int = DEFAULTS.ring_min_size,
    density: float | None = None,
    split: int = SPLIT,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Size, edge count and density of ego networks of at least ``min_size`` nodes.

    With a ``density`` only the networks reaching it are returned, and the graph
    is cut down to where one is possible before any triangle is looked for.
    """
    scratch = scratch_for(pairs, scratch)
    edges = scratch.cut(with_degrees(pairs, keys, scratch), "edges")
    seeds = density_candidates(edges, keys, min_size, density)
    if density is not None:
        seeds = scratch.cut(seeds, "seeds")
        edges = scratch.cut(_around(edges, seeds, keys, scratch), "near")
    corners = triangles(edges, keys, split).select(
        *keys, F.explode(F.array("u", "v", "w")).alias("node")
    )
    closed = corners.groupBy(*keys, "node").agg(F.count(F.lit(1)).alias("t"))
    egos = seeds.join(closed, [*keys, "node"], "left").select(
        *keys,
        "node",
        (F.col("k") + 1).alias("node_count"),
        (F.col("k") + F.coalesce("t", F.lit(0))).alias("ego_edges"),
        ((F.col("k") + F.coalesce("t", F.lit(0))) / _possible(F.col("k"))).alias("density"),
    )
    return egos if density is None else egos.filter(F.col("density") >= density)
