"""One query per operator or natural group of operators."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.functions import text as T
from ringwatch.functions.prices import body_pct
from ringwatch.functions.times import parse_time
from ringwatch.operators import alerts as A
from ringwatch.operators import batches as B
from ringwatch.operators import ego, graph, polls, quality, reports, rings
from ringwatch.params import Params
from ringwatch.plans import adapters
from ringwatch.session import Scratch
from ringwatch.sinks.topics import topic_records as to_topic
from ringwatch.sources import events as E
from ringwatch.sources import ohlcv, snapshots, stats, tweets

Query = Callable[[SparkSession, str], DataFrame]

# Lower than the defaults where the test tables are too small for them.
DAILY = Params(star_min_degree=5)
WEEKLY_RINGS = {"min_size": 4, "density": 0.4}
SEQ = ["event_id"]
TIES = ["alert_type", "hub_node", "seed_node"]


def _text(column: str, name: str = "batch"):
    return F.col(column).cast("string").alias(name)


def _joined(column: str):
    return F.coalesce(F.array_join(column, "|"), F.lit("")).alias(column)


def _links(spark, sf_dir, key):
    events = adapters.market_events(spark, sf_dir, adapters.SOCIAL_KINDS)
    edges = graph.interaction_edges(events, [key], SEQ)
    return graph.compact_links(edges, [key])


def decode_route_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = E.decode(adapters.event_records(spark, sf_dir))
    kinds = [
        F.count_if(F.col("event_type") == "social_interaction").alias("social_count"),
        F.count_if(F.col("event_type") == "price_candle").alias("price_count"),
        F.count_if(F.col("is_bot")).alias("bot_count"),
        F.count_if(F.col("pumping")).alias("pumping_count"),
        F.count(F.lit(1)).alias("event_count"),
    ]
    return events.groupBy("day").agg(*kinds).select(_text("day"), "*").drop("day")


def interaction_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.date_format(F.window("ts", "10 minutes").start, "yyyy-MM-dd HH:mm")
    events = adapters.market_events(spark, sf_dir, adapters.SOCIAL_KINDS).withColumn("batch", slot)
    edges = graph.gate_edges(graph.interaction_edges(events, ["batch"], SEQ), ["batch"])
    return edges.select("batch", "seq", "src", "dst")


def degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = graph.degrees(_links(spark, sf_dir, "week"), ["week"])
    return found.select(_text("week"), "node", "out_degree", "in_degree")


def undirected_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.undirected_edges(_links(spark, sf_dir, "week"), ["week"]).select(_text("week"), "a", "b")


def star_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = graph.detect_stars(_links(spark, sf_dir, "week"), ["week"])
    return found.select(_text("week"), "hub_node", "out_degree", "out_ratio", "severity")


def ego_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = graph.undirected_edges(_links(spark, sf_dir, "day"), ["day"])
    egos = ego.ego_density(pairs, ["day"], min_size=4)
    return egos.select(_text("day"), "node", "node_count", "ego_edges", F.round("density", 6).alias("density"))


def ring_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rings.detect_rings(_links(spark, sf_dir, "week"), ["week"], **WEEKLY_RINGS)
    return found.select(
        _text("week"), "seed_node", _joined("nodes"), "node_count", "edge_density", "severity"
    )


def ring_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All members of the rings of ``ring_alerts``, one row each."""
    links = _links(spark, sf_dir, "week")
    found = rings.detect_rings(links, ["week"], **WEEKLY_RINGS)
    seeds = found.select("week", F.col("seed_node").alias("node"))
    members = rings.ring_members(seeds, graph.undirected_edges(links, ["week"]), ["week"])
    return members.select(_text("week"), F.col("node").alias("seed_node"), "member")


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = B.batch_summary(adapters.market_events(spark, sf_dir), ["day"])
    return _summary_form(summary, _text("day"))


def _summary_form(summary, key):
    return summary.select(
        key,
        "event_count", "social_count", "price_count", "edge_count", "bot_count",
        F.round("gt_bot_ratio", 6).alias("gt_bot_ratio"),
        F.col("price_pumping").cast("int").alias("price_pumping"),
        _joined("pumping_tokens"),
        F.col("ground_truth").cast("int").alias("ground_truth"),
    )


def tumbling_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.market_events(spark, sf_dir)
    summary = B.batch_summary(events.withColumn("window", F.window("ts", "1 day")), ["window"])
    start = F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return _summary_form(summary, start)


def _detection(spark, sf_dir, **options) -> A.Detection:
    events = adapters.market_events(spark, sf_dir)
    at = F.col("day").cast("timestamp")
    return A.detect(events, ["day"], SEQ, DAILY, detected_at=at, **options)


def batch_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _detection(spark, sf_dir, shown=0).scored
    return scored.select(_text("day"), "star_count", "ring_count", "score", "confidence")


def alerts_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_form(_detection(spark, sf_dir).alerts)


def _alert_form(alerts: DataFrame) -> DataFrame:
    """Alerts as flat values: what a kind of alert lacks reads as empty, 0 or false."""
    columns = []
    for name, kind in alerts.dtypes:
        column = F.col(name)
        if name == "day":
            columns.append(_text("day"))
        elif kind.startswith("array"):
            columns.append(_joined(name))
        elif kind == "timestamp":
            columns.append(F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name))
        elif kind == "string":
            columns.append(F.coalesce(column, F.lit("")).alias(name))
        elif kind == "boolean":
            columns.append(F.coalesce(column.cast("int"), F.lit(0)).alias(name))
        else:
            columns.append(F.coalesce(column, F.lit(0).cast(kind)).alias(name))
    return alerts.select(*columns)


def _quality(spark, sf_dir):
    scored = _detection(spark, sf_dir, shown=0).scored
    outcomes = B.batch_outcomes(scored, ["day"])
    return scored, outcomes, quality.running_quality(outcomes, "day")


def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _, running = _quality(spark, sf_dir)
    status = B.batch_status(scored, running, ["day"])
    return status.select(_text("day"), "status", F.col("persisted").cast("int").alias("persisted"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found, _ = _quality(spark, sf_dir)
    return found.select(
        _text("day"),
        F.col("ground_truth").cast("int").alias("ground_truth"),
        F.col("detected").cast("int").alias("detected"),
        "outcome",
    )


_QUALITY = [
    "true_positives", "false_positives", "false_negatives", "total_batches",
    "precision", "recall", "f1_score",
]


def running_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, running = _quality(spark, sf_dir)
    return running.select(_text("day"), *_QUALITY)


def quality_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found, _ = _quality(spark, sf_dir)
    snapshot = quality.quality_snapshot(found)
    gauges = quality.quality_gauges(snapshot)
    percent = [F.round(c, 3).alias(c) for c in gauges.columns if c.endswith("_pct")]
    return gauges.select(*_QUALITY, *percent, "precision_card")


def stored_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, running = _quality(spark, sf_dir)
    stored = quality.stored_snapshot(running, "day", F.col("day").cast("string"))
    return stored.select(*_QUALITY, "updated_at")


def quality_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found, _ = _quality(spark, sf_dir)
    epoch = F.floor(F.datediff("day", F.lit("2024-01-01").cast("date")) / 10).cast("bigint")
    running = quality.running_quality(found.withColumn("epoch", epoch), "day", "epoch")
    return running.select("epoch", _text("day"), *_QUALITY)


def quality_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that start again on every day with an error of a value above 250."""
    _, found, _ = _quality(spark, sf_dir)
    events = adapters.table(spark, sf_dir, "events").filter((F.col("event_type") == "error") & (F.col("value") > 250))
    markers = events.select(F.col("ts").cast("date").alias("day")).distinct()
    running = quality.running_quality(quality.batch_epochs(found, markers, "day"), "day", "epoch")
    return running.select(F.coalesce(F.col("epoch").cast("string"), F.lit("")).alias("epoch"), _text("day"), *_QUALITY)


def candles_body_pump(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles = ohlcv.to_candles(adapters.monthly_candles(spark, sf_dir))
    return candles.select(
        "event_type", "symbol", "timestamp", "open", "high", "low", "close", "volume",
        body_pct(F.col("open"), F.col("close")).alias("body_pct"),
        F.col("pumping").cast("int").alias("pumping"), "source",
    )


def ohlcv_headers_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles = adapters.monthly_candles(spark, sf_dir)
    file = F.concat(F.lit("coin_"), F.initcap("symbol"), F.lit("_price.csv"))
    own = F.when(F.substring("symbol", 2, 5).cast("int") % 2 == 0, F.lower("symbol"))
    named = candles.select("date", file.alias("file"), own.alias("own"))
    resolved = T.resolved_symbol(F.col("own"), F.col("file"))
    return named.select(
        "date", "file", resolved.alias("symbol"), T.file_symbol(F.col("file")).alias("file_symbol"),
        T.file_coin(F.col("file")).alias("coin"),
    )


def poll_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = polls.poll_changes(adapters.monthly_polls(spark, sf_dir), spike_pct=10.0)
    return changes.select(
        "token", _text("poll_ts", "poll_ts"), "price_usd", "previous_price", "change_since_last_poll_pct",
        F.col("pumping").cast("int").alias("pumping"),
    )


def snapshot_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = snapshots.flatten_snapshots(adapters.snapshot_documents(spark, sf_dir))
    return flat.select(
        _text("poll_ts", "poll_ts"), "token", "symbol", "price_usd", "volume_24h_usd", "change_24h_pct"
    )


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    social = E.social(adapters.market_events(spark, sf_dir, adapters.SOCIAL_KINDS))
    fields = [
        "event_type", "source_user", "target_user", "interaction_type", "token_mentioned",
        "timestamp", "is_bot", "pump_signal", "source",
    ]
    records = to_topic(social, F.col("source_user"), fields)
    keeps_nulls = F.col("value").contains('"token_mentioned":null').cast("int").alias("keeps_nulls")
    decoded = E.decode(records.select("key", keeps_nulls, "value"))
    return decoded.select(
        "key", "keeps_nulls", "target_user", "interaction_type", "timestamp",
        F.col("is_bot").cast("int").alias("is_bot"), F.col("pump_signal").cast("int").alias("pump_signal"),
    )


def tweet_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = adapters.posts(spark, sf_dir).select("doc_id", T.at_mentions(F.col("text")).alias("mentions"))
    return found.select("doc_id", _joined("mentions"), F.size("mentions").alias("n_mentions"))


def tweet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = adapters.posts(spark, sf_dir).select("doc_id", T.token_mentions(F.col("text")).alias("tokens"))
    return found.select("doc_id", _joined("tokens"), F.size("tokens").alias("n_tokens"))


def tweet_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = tweets.tweets_to_interactions(adapters.posts(spark, sf_dir))
    return edges.select(
        "doc_id", "position", "event_type", "source_user", "target_user", "interaction_type",
        F.coalesce("token_mentioned", F.lit("")).alias("token_mentioned"), "timestamp", "source",
    )


def tweet_csv_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts written as CSV files of two headers and read back in byte ranges, their times parsed."""
    files = adapters.post_files(spark, sf_dir, Scratch(spark))
    edges = tweets.tweets_to_interactions(tweets.read_tweets(spark, files))
    return edges.select(
        "source_user", "target_user", F.coalesce("token_mentioned", F.lit("")).alias("token_mentioned"),
        F.date_format(parse_time(F.col("timestamp")), "yyyy-MM-dd").alias("day"),
    )


def ohlcv_csv_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candles written as CSV files of two headers and read back as one table."""
    files = adapters.candle_files(spark, sf_dir, Scratch(spark))
    candles = ohlcv.to_candles(ohlcv.read_ohlcv(spark, files))
    return candles.select(
        "symbol", F.date_format(parse_time(F.col("timestamp")), "yyyy-MM-dd").alias("day"),
        "open", "high", "low", "close", "volume", F.col("pumping").cast("int").alias("pumping"),
    )


def _alerts(spark, sf_dir):
    """The alerts for reports that do not list the members of rings."""
    return _detection(spark, sf_dir, shown=0).alerts


def latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_form(reports.latest_alerts(_detection(spark, sf_dir).alerts, TIES))


def alert_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.alert_kpis(_alerts(spark, sf_dir))


def alerts_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.alerts_by_type(_alerts(spark, sf_dir))


def alerts_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.alerts_timeline(_alerts(spark, sf_dir))
    minute = F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss").alias("detected_at")
    return found.select(minute, "alert_type", "count")


def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_tokens(_alerts(spark, sf_dir))


def alert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_form(reports.alert_table(_alerts(spark, sf_dir), TIES))


def alert_table_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as the dashboard shows it: its first 50 rows."""
    return _alert_form(reports.alert_table(_alerts(spark, sf_dir), TIES, n=50))


def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [
        stats.dataset_stats(stats.per_file(adapters.table(spark, sf_dir, name)), name)
        for name in ("events", "lineitem", "documents")
    ]
    return stats.combined(found).select("dataset", "n_files", "n_rows")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        decode_route_events, interaction_edges, degrees, undirected_edges, star_hubs, ego_density,
        ring_alerts, ring_members, batch_summary, tumbling_summary, batch_confidence, alerts_enriched, batch_status,
        outcomes, running_quality, quality_snapshot, stored_snapshot, quality_epochs, quality_resets,
        candles_body_pump, ohlcv_headers_symbols, poll_spikes, snapshot_flatten, topic_records,
        tweet_mentions, tweet_tokens, tweet_edges, tweet_csv_edges, ohlcv_csv_candles, latest_alerts, alert_kpis,
        alerts_by_type, alerts_timeline, top_tokens, alert_table, alert_table_first, dataset_stats,
    )
}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly detection with the default thresholds: the enriched alerts."""
    events = adapters.market_events(spark, sf_dir)
    at = F.col("week").cast("timestamp")
    return A.detect(events, ["week"], SEQ, detected_at=at).alerts
