import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ringwatch.operators import alerts, batches, ego, graph, polls, quality, reports, rings
from ringwatch.params import Params
from ringwatch.schemas import EVENT

EDGES = "batch string, seq long, src string, dst string"


def links(spark, edges, b="x"):
    rows = [e if len(e) == 4 else (b, i, *e) for i, e in enumerate(edges)]
    return graph.compact_links(spark.createDataFrame(rows, EDGES), ["batch"])


def clique(n, name="n"):
    return [(f"{name}{i:03}", f"{name}{j:03}") for i in range(n) for j in range(i + 1, n)]


# Given cases.


def test_graph(spark):
    found = links(spark, [("alice", "bob"), ("alice", "charlie"), ("bob", "alice")])
    degrees = {r.node: (r.out_degree, r.in_degree) for r in graph.degrees(found, ["batch"]).collect()}
    assert degrees == {"alice": (2, 1), "bob": (1, 1), "charlie": (0, 1)}
    pairs = graph.undirected_edges(found, ["batch"]).collect()
    assert {(r.a, r.b) for r in pairs} == {("alice", "bob"), ("alice", "charlie")}


@pytest.mark.parametrize("edges,stars", [
    ([("hub", f"l{i}") for i in range(15)], [("hub", 15, 1.0, "HIGH")]),
    ([("hub", f"l{i}") for i in range(5)], []),
    ([("hub", f"l{i}") for i in range(12)] + [(f"m{i}", "hub") for i in range(12)], []),
    ([("hub", "one")] * 10, [("hub", 10, 1.0, "HIGH")]),
])
def test_stars(spark, edges, stars):
    found = graph.detect_stars(links(spark, edges), ["batch"]).collect()
    assert [(r.hub_node, r.out_degree, r.out_ratio, r.severity) for r in found] == stars


def test_ring_of_six_and_chain(spark):
    found = rings.detect_rings(links(spark, clique(6)), ["batch"]).collect()
    assert [(r.node_count, r.edge_density, r.severity) for r in found] == [(6, 1.0, "CRITICAL")]
    chain = [(f"c{i}", f"c{i + 1}") for i in range(8)]
    assert rings.detect_rings(links(spark, chain), ["batch"]).count() == 0


@pytest.mark.parametrize("stars,ring_count,pumping,ratio,label,score", [
    (0, 0, False, 0.0, "LOW", 0), (1, 0, False, 0.0, "MEDIUM", 2), (1, 0, True, 0.0, "HIGH", 5),
    (1, 1, True, 0.2, "CRITICAL", 9), (3, 0, True, 0.0, "CRITICAL", 9), (2, 0, False, 0.0, "MEDIUM", 4),
    (0, 0, False, 0.99, "MEDIUM", 4),
])
def test_confidence(spark, stars, ring_count, pumping, ratio, label, score):
    summary = spark.createDataFrame(
        [("x", 5, 5, 0, 5, 1, pumping, [], False, ratio)],
        "batch string, event_count long, social_count long, price_count long, edge_count long, bot_count long, "
        "price_pumping boolean, pumping_tokens array<string>, ground_truth boolean, gt_bot_ratio double",
    )
    found = spark.createDataFrame(
        [("x", "STAR_TOPOLOGY")] * stars + [("x", "CLIQUE_DETECTED")] * ring_count, "batch string, alert_type string"
    )
    scored = batches.score_batches(summary, found, ["batch"]).first()
    assert (scored.confidence, scored.score) == (label, score)


def test_running_quality(spark):
    rows = [(0, "TP", True), (1, "FP", True), (2, "FN", False), (3, "TN", True)]
    outcomes = spark.createDataFrame(rows, "batch_id long, outcome string, persisted boolean")
    found = quality.running_quality(outcomes, "batch_id").orderBy("batch_id").collect()
    assert [(r.precision, r.recall, r.f1_score) for r in found] == [
        (1.0, 1.0, 1.0), (0.5, 1.0, 0.667), (0.5, 0.5, 0.5), (0.5, 0.5, 0.5)
    ]
    last = quality.quality_snapshot(outcomes).first()
    assert (last.total_batches, last.true_positives, last.false_positives, last.false_negatives) == (4, 1, 1, 1)
    assert quality.running_quality(outcomes.union(outcomes.select(F.lit(None), "outcome", "persisted").limit(1)),
                                   "batch_id").count() == 5


# Derived cases, and a sequential checker on random graphs.


def sequential_rings(edges, min_size, density):
    near, order = defaultdict(set), []
    for _, s, d in edges:
        for n, m in ((s, d), (d, s)):
            if n not in near:
                order.append(n)
            near[n].add(m)
    found, visited = {}, set()
    for n in order:
        if n in visited:
            continue
        group = near[n] | {n}
        size = len(group)
        inside = sum(1 for x in group for y in near[x] if y in group and x < y)
        share = inside / (size * (size - 1) / 2) if size > 1 else 0
        if size >= min_size and share >= density:
            found[n] = (size, round(share, 3))
            visited |= group
    return found


@pytest.mark.parametrize("seed,scanned", [(0, 100_000), (1, 12), (2, 0)])
def test_rings_on_random_graphs(spark, monkeypatch, seed, scanned):
    """With small batches scanned in one task, with some of them, and in rounds alone."""
    monkeypatch.setattr(rings.first_independent_set, "__defaults__", (None, scanned))
    r = random.Random(seed)
    rows = []
    for b in range(25):
        n = r.randint(4, 14)
        for _ in range(r.randint(3, 5 * n)):
            rows.append((f"g{b}", len(rows), f"u{r.randrange(n)}", f"u{r.randrange(n)}"))
    found = rings.detect_rings(links(spark, rows), ["batch"], 4, 0.5, split=3).collect()
    mine = Counter((x.batch, x.seed_node, x.node_count) for x in found)
    wanted = Counter()
    for b in {x[0] for x in rows}:
        for seed_node, (size, _) in sequential_rings([x[1:] for x in rows if x[0] == b], 4, 0.5).items():
            wanted[b, seed_node, size] += 1
    assert mine == wanted


@pytest.mark.parametrize("n", [60, 600])
def test_rings_on_a_long_squared_chain(spark, n):
    """Chains of any length are scanned in one step."""
    names = [f"c{i:04}" for i in range(n)]
    edges = [(names[i], names[j]) for i in range(n) for j in (i + 1, i + 2) if j < n]
    found = rings.detect_rings(links(spark, edges), ["batch"], 4, 0.5).collect()
    wanted = sequential_rings([(i, *e) for i, e in enumerate(edges)], 4, 0.5)
    assert {x.seed_node for x in found} == set(wanted)


def test_all_ring_members_are_kept(spark):
    found = links(spark, clique(25))
    ring = rings.detect_rings(found, ["batch"]).first()
    assert len(ring.nodes) == 20 and ring.node_count == 25
    seeds = spark.createDataFrame([("x", ring.seed_node)], "batch string, node string")
    pairs = graph.undirected_edges(found, ["batch"])
    members = rings.ring_members(seeds, pairs, ["batch"])
    assert members.count() == 25


def test_ego_density_counts_loops_as_nothing(spark):
    edges = [("a", "a"), ("a", "b"), ("a", "c"), ("a", "d")]
    pairs = graph.undirected_edges(links(spark, edges), ["batch"])
    assert ego.ego_density(pairs, ["batch"], 5).count() == 0
    assert ego.ego_density(pairs, ["batch"], 4).first().node_count == 4


def test_a_hub_beside_a_ring(spark):
    hub = [("x", i, "hub", f"leaf{i}") for i in range(20_000)]
    ring = [("x", 20_000 + i, *e) for i, e in enumerate(clique(6, "r"))]
    found = rings.detect_rings(links(spark, hub + ring), ["batch"], split=2_000).collect()
    assert [r.node_count for r in found] == [6]


def events(spark, rows):
    fields = EVENT.fieldNames()
    filled = [tuple(r.get(f) for f in ["key", "event_id", *fields]) for r in rows]
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("key", StringType()), StructField("event_id", LongType()), *EVENT.fields])
    return spark.createDataFrame(filled, schema)


def star_of(key, n, start=0):
    return [
        {"key": key, "event_id": start + i, "event_type": "social_interaction", "source_user": "hub",
         "target_user": f"l{i}", "is_bot": False, "pump_signal": True}
        for i in range(n)
    ]


def test_null_batch_keys_raise_alerts_too(spark):
    rows = star_of(None, 15) + star_of("k", 15, 100)
    rows.append({"key": None, "event_id": 999, "event_type": "price_candle", "symbol": "BTC", "pumping": True})
    found = alerts.detect(events(spark, rows), ["key"], ["event_id"])
    kinds = Counter((r.key, r.alert_type) for r in found.alerts.collect())
    assert kinds == {(None, "STAR_TOPOLOGY"): 1, (None, "PUMP_AND_DUMP_CONFIRMED"): 1, ("k", "STAR_TOPOLOGY"): 1}
    scored = {r.key: (r.edge_count, r.star_count, r.confidence) for r in found.scored.collect()}
    assert scored == {None: (15, 1, "HIGH"), "k": (15, 1, "MEDIUM")}


def test_gate_and_summary(spark):
    rows = star_of("two", 2)
    rows += [{"key": "bad", "event_id": 50}, {"key": "p", "event_id": 51, "event_type": "price_candle", "symbol": ""}]
    rows += [{"key": "p", "event_id": 52, "event_type": "price_candle", "symbol": "", "pumping": True}]
    rows += [{"key": "e", "event_id": 60, "event_type": "social_interaction", "source_user": "", "target_user": "x"}]
    found = alerts.detect(events(spark, rows), ["key"], ["event_id"], Params(star_min_degree=1, ring_min_size=2))
    assert found.alerts.filter("key = 'two'").count() == 0
    s = {r.key: r for r in found.scored.collect()}
    assert (s["bad"].event_count, s["bad"].social_count, s["bad"].price_count) == (1, 0, 0)
    assert s["p"].price_pumping and s["p"].pumping_tokens == [] and s["p"].gt_bot_ratio == 0
    assert (s["e"].social_count, s["e"].edge_count) == (1, 0)
    assert graph.gate_edges(
        graph.interaction_edges(events(spark, star_of("two", 2) + star_of("t", 3, 9)), ["key"], ["event_id"]), ["key"]
    ).select("key").distinct().collect()[0].key == "t"


def test_reports_read_all_alerts(spark):
    rows = [("STAR_TOPOLOGY", "HIGH", ["A"], f"2024-01-01 00:{i % 60:02}:00") for i in range(500)]
    rows += [("X", "LOW", ["A", "B"], "bad"), ("X", "CRITICAL", [], None), ("X", "LOW", None, None)]
    df = spark.createDataFrame(rows, "alert_type string, severity string, pumping_tokens array<string>, detected_at string")
    k = reports.alert_kpis(df).first()
    assert (k.total, k.critical, k.high, k.confirmed) == (503, 1, 500, 0)
    assert sum(r["count"] for r in reports.alerts_timeline(df).collect()) == 500
    assert [(r.token, r.alert_count) for r in reports.top_tokens(df).collect()] == [("A", 501), ("B", 1)]
    assert reports.alert_table(df, []).count() == 501
    assert reports.alert_table(df, [], severities=[]).count() == 503
    assert reports.alert_table(df, [], n=50).count() == 50
    assert reports.latest_alerts(df, []).count() == 300


def test_polls(spark):
    rows = [("t", i, p) for i, p in enumerate([100.0, 100.2, 100.2, 0.0, 50.0])]
    rows += [(None, 1, 10.0), (None, 2, 20.0), ("u", None, 5.0), ("u", 3, 10.0), ("n", 1, float("nan")), ("n", 2, 4.0)]
    df = spark.createDataFrame(rows, "token string, poll_ts long, price_usd double")
    found = polls.poll_changes(df)
    assert found.count() == len(rows)
    got = {(r.token, r.poll_ts): (r.change_since_last_poll_pct, r.pumping) for r in found.collect()}
    assert [got["t", i][0] for i in range(5)] == [0.0, 0.2, 0.0, -100.0, 0.0] and got["t", 3][1]
    assert got[None, 2] == (100.0, True) and got["u", 3] == (100.0, True)
    assert got["n", 2] == (0.0, False)


def test_poll_candles(spark):
    df = spark.createDataFrame([("BTC", 1.5, 2.0, 0.123456, 0.5, True, 7)],
                               "symbol string, price_usd double, volume_24h_usd double, change_24h_pct double, "
                               "change_since_last_poll_pct double, pumping boolean, poll_ts long")
    row = polls.poll_candles(df).first()
    assert (row.event_type, row.change_24h_pct, row.change_since_last_poll, row.timestamp) == ("price_candle", 0.1235, 0.5, "7")
