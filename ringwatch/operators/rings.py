"""Dense rings: qualifying ego networks under first-come suppression.

Nodes are taken in order of first appearance; one that qualifies raises an alert
and silences its whole ego network. Only qualifying nodes can raise, so the
alerting ones are the lexicographically first independent set among them, which
is found in rounds (Blelloch, Fineman & Shun 2012) with the sequential result.
"""

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.operators.ego import SPLIT, both_ends, ego_density
from ringwatch.operators.graph import undirected_edges
from ringwatch.params import DEFAULTS
from ringwatch.schemas import RING
from ringwatch.session import Scratch, scratch_for

# Fixed values of the ring alert.
SHOWN_NODES = 20
CRITICAL_DENSITY = 0.8

#: Conflict pairs of a batch that one task may scan.
SCANNED = 100_000
GROUP = "_group"


def first_seen(links: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Rank of the given nodes by first appearance, a source before its target.

    The edge's own users complete the order, so ranks never tie between nodes.
    """

    def side(end, i):
        return F.struct(
            F.col(end).alias("node"),
            F.struct("seq", "src", "dst", F.lit(i).alias("side")).alias("rank"),
        )

    ends = links.select(*keys, F.explode(F.array(side("src", 0), side("dst", 1))).alias("e"))
    wanted = ends.select(*keys, "e.*").join(nodes.select(*keys, "node"), [*keys, "node"], "left_semi")
    return wanted.groupBy(*keys, "node").agg(F.min("rank").alias("rank"))


def _scan(pairs: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one batch that are chosen: none of the neighbours before them is.

    ``lo`` stands before ``hi``; a node stands in the table as a pair with itself.
    """
    before: dict[str, list[str]] = {}
    after: dict[str, list[str]] = {}
    for lo, hi in zip(pairs["lo"], pairs["hi"]):
        before.setdefault(hi, [])
        if lo != hi:
            before[hi].append(lo)
            after.setdefault(lo, []).append(hi)
    waiting = {node: len(lows) for node, lows in before.items()}
    ready = [node for node, n in waiting.items() if not n]
    chosen: dict[str, bool] = {}
    for node in ready:
        chosen[node] = not any(chosen[lo] for lo in before[node])
        for hi in after.get(node, ()):
            waiting[hi] -= 1
            if not waiting[hi]:
                ready.append(hi)
    picked = [node for node, yes in chosen.items() if yes]
    return pd.DataFrame({GROUP: [pairs[GROUP].iloc[0]] * len(picked), "node": picked})


def _decide(open_pairs: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """``keys, node, chosen`` of the nodes without lower neighbours, which are chosen, and of the chains on them.

    A node with one lower neighbour is chosen if that one is not. So along a chain of such nodes choice follows
    from the first of them: each points at its neighbour, with one turn between them, and in every
    step at what that one points at, with the turns of both, which doubles the length that is passed.
    """
    conflict = F.col("lo") != F.col("hi")
    lower = open_pairs.groupBy(*keys, F.col("hi").alias("node")).agg(
        F.count_if(conflict).alias("n"), F.max(F.when(conflict, F.col("lo"))).alias("anchor")
    )
    lower = scratch.cut(lower, "lower")
    heads = lower.filter("n = 0").select(*keys, "node")
    pointers = lower.filter("n = 1").select(*keys, "node", "anchor", F.lit(1).alias("turns"))
    while True:
        pointers = scratch.cut(pointers, "pointers")
        onward = pointers.select(
            *keys, F.col("node").alias("anchor"), F.col("anchor").alias("next"), F.col("turns").alias("more")
        )
        moved = pointers.join(onward, [*keys, "anchor"])
        if moved.isEmpty():
            break
        pointers = pointers.join(onward, [*keys, "anchor"], "left").select(
            *keys, "node", F.coalesce("next", "anchor").alias("anchor"),
            ((F.col("turns") + F.coalesce("more", F.lit(0))) % 2).alias("turns"),
        )
    hung = pointers.join(heads.withColumnRenamed("node", "anchor"), [*keys, "anchor"], "left_semi")
    found = heads.withColumn("chosen", F.lit(True)).unionByName(
        hung.select(*keys, "node", (F.col("turns") % 2 == 0).alias("chosen"))
    )
    return scratch.cut(found, "decided")


def first_independent_set(
    ranked: DataFrame,
    pairs: DataFrame,
    keys: list[str],
    scratch: Scratch | None = None,
    scanned: int = SCANNED,
) -> DataFrame:
    """Nodes chosen by scanning in rank order and skipping neighbours of chosen ones.

    The conflicts of a batch, which lie among qualifying nodes only, are scanned in
    one task as long as they are at most ``scanned`` pairs, however long their chains
    are. A larger batch goes through rounds until it is as small: each round chooses
    every open node without an open neighbour of lower rank, decides the chains that hang from
    them, and closes the neighbours of all that are chosen. The lowest open node of a batch is always chosen, so
    the rounds end; only emptiness tests reach the driver. A chain of any length takes one round, of as many
    steps as its length has binary digits; a round is needed for each node with several
    neighbours of lower rank that lie on one path.
    """
    scratch = scratch_for(ranked, scratch)

    # A plain table, so that a node with many conflicts can be split in the joins.
    ranked = scratch.cut(ranked, "ranked")

    def end(name):
        return ranked.select(*keys, F.col("node").alias(name), F.col("rank").alias(f"r{name}"))

    linked = pairs.join(end("a"), [*keys, "a"]).join(end("b"), [*keys, "b"])
    a_first = F.col("ra") < F.col("rb")
    ordered = linked.select(
        *keys,
        F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("lo"),
        F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("hi"),
    ).filter(F.col("lo") != F.col("hi"))
    # An open node stands in the table as a pair with itself.
    self_pairs = ranked.select(*keys, F.col("node").alias("lo"), F.col("node").alias("hi"))
    # A text that names the batch, null keys included, for the trip through pandas.
    group = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias(GROUP)
    open_pairs = scratch.cut(ordered.unionByName(self_pairs).select("*", group), "open")
    conflict = F.col("lo") != F.col("hi")
    chosen = []
    while True:
        sizes = open_pairs.groupBy(GROUP).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= scanned)
        small = open_pairs.join(sizes.select(GROUP), GROUP, "left_semi")
        picked = small.select(GROUP, "lo", "hi").groupBy(GROUP).applyInPandas(_scan, f"{GROUP} string, node string")
        nodes = open_pairs.filter(~conflict).select(*keys, GROUP, F.col("lo").alias("node"))
        chosen.append(nodes.join(picked, [GROUP, "node"], "left_semi").select(*keys, "node"))
        large = open_pairs.join(sizes.select(GROUP), GROUP, "left_anti")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, chosen)
        open_pairs = scratch.cut(large, "large")
        decided = _decide(open_pairs, keys, scratch)
        silenced = (
            open_pairs.filter(conflict)
            .join(decided.filter("chosen").select(*keys, F.col("node").alias("lo")), [*keys, "lo"], "left_semi")
            .select(*keys, F.col("hi").alias("node"))
            .distinct()
            .join(decided.select(*keys, "node"), [*keys, "node"], "left_anti")
        )
        closed = scratch.cut(
            decided.unionByName(silenced.withColumn("chosen", F.lit(False))), "closed"
        )
        chosen.append(closed.filter("chosen").select(*keys, "node"))
        if len(chosen) >= 16:
            chosen = [scratch.cut(reduce(DataFrame.unionByName, chosen), "chosen")]
        done = closed.select(*keys, "node")
        for side in ("lo", "hi"):
            open_pairs = open_pairs.join(
                done.withColumnRenamed("node", side), [*keys, side], "left_anti"
            )
        open_pairs = scratch.cut(open_pairs, "open")


def ring_members(seeds: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Every member of each seed's ego network, the seed included: one row each."""
    a, b = F.col("a"), F.col("b")
    proper = pairs.filter(a != b)
    neighbours = both_ends(proper, keys, ("member", b, a)).join(
        seeds.select(*keys, "node"), [*keys, "node"], "left_semi"
    )
    return neighbours.unionByName(seeds.select(*keys, "node", F.col("node").alias("member")))


def shown_members(members: DataFrame, keys: list[str], limit: int = SHOWN_NODES) -> DataFrame:
    """The list of the first ``limit`` members in name order, for display.

    The limit is applied by rank before the shuffle, so a task never gathers more
    than the members that are shown; ``ring_members`` has them all.
    """
    by_name = Window.partitionBy(*keys, "node").orderBy("member")
    shown = members.withColumn("_i", F.row_number().over(by_name)).filter(F.col("_i") <= limit)
    return shown.groupBy(*keys, "node").agg(F.array_sort(F.collect_list("member")).alias("nodes"))


def detect_rings(
    links: DataFrame,
    keys: list[str],
    min_size: int = DEFAULTS.ring_min_size,
    density: float = DEFAULTS.ring_density,
    split: int = SPLIT,
    scratch: Scratch | None = None,
    shown: int = SHOWN_NODES,
) -> DataFrame:
    """Ring alerts from ``compact_links``; seeds in first-come order suppress their neighbours.

    ``nodes`` lists the first ``shown`` members; with 0 it is null, which spares the joins that find them.
    """
    scratch = scratch_for(links, scratch)
    pairs = scratch.cut(undirected_edges(links, keys), "pairs")
    egos = scratch.cut(ego_density(pairs, keys, min_size, density, split, scratch), "egos")
    ranked = first_seen(links, egos, keys)
    seeds = first_independent_set(ranked, pairs, keys, scratch)
    alerts = egos.join(seeds, [*keys, "node"], "left_semi")
    severity = F.when(F.col("density") > CRITICAL_DENSITY, "CRITICAL").otherwise("HIGH")
    if shown:
        alerts = alerts.join(shown_members(ring_members(seeds, pairs, keys), keys, shown), [*keys, "node"])
    else:
        alerts = alerts.withColumn("nodes", F.lit(None).cast("array<string>"))
    return alerts.select(
        *keys,
        F.lit(RING).alias("alert_type"),
        severity.alias("severity"),
        F.col("node").alias("seed_node"),
        "nodes",
        "node_count",
        F.round("density", 3).alias("edge_density"),
    )
