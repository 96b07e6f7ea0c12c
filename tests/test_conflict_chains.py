import random

import pytest

from ringwatch.operators import rings
from ringwatch.session import Scratch


class Counting(Scratch):
    """Counts the tables of each label."""

    def __init__(self, spark):
        super().__init__(spark)
        self.labels = []

    def cut(self, df, label):
        self.labels.append(label)
        return super().cut(df, label)


def sequential(ranks, pairs):
    """Nodes in order of rank, less those beside a chosen one."""
    beside = {}
    for _, a, b in pairs:
        beside.setdefault(a, set()).add(b)
        beside.setdefault(b, set()).add(a)
    chosen = set()
    for node in sorted(ranks, key=ranks.get):
        if not beside.get(node, set()) & chosen:
            chosen.add(node)
    return chosen


def found(spark, ranks, pairs, scanned):
    scratch = Counting(spark)
    ranked = spark.createDataFrame([("k", n, r) for n, r in ranks.items()], "k string, node string, rank long")
    linked = spark.createDataFrame(pairs, "k string, a string, b string")
    got = rings.first_independent_set(ranked, linked, ["k"], scratch, scanned)
    return {r.node for r in got.collect()}, scratch.labels


def test_a_long_chain_takes_few_steps(spark):
    n = 20_000
    ranks = {f"n{i:06}": i for i in range(n)}
    pairs = [("k", f"n{i:06}", f"n{i + 1:06}") for i in range(n - 1)]
    got, labels = found(spark, ranks, pairs, 10)
    assert got == {f"n{i:06}" for i in range(0, n, 2)}
    assert labels.count("closed") == 1 and labels.count("pointers") <= 17


@pytest.mark.parametrize("seed", range(4))
def test_chains_trees_and_meshes(spark, seed):
    draw, pairs = random.Random(seed), set()
    nodes = [f"n{i}" for i in range(160)]
    order = list(nodes)
    draw.shuffle(order)
    ranks = {n: i for i, n in enumerate(order)}
    for i in range(1, 120):  # trees, whose chains run in any order of rank
        pairs.add(tuple(sorted((nodes[i], nodes[draw.randrange(max(0, i - 3), i)]))))
    for _ in range((0, 10, 40, 200)[seed]):
        pairs.add(tuple(sorted(draw.sample(nodes, 2))))
    pairs = [("k", a, b) for a, b in sorted(pairs)]
    assert found(spark, ranks, pairs, 0)[0] == sequential(ranks, pairs)
