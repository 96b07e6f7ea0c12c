"""Reporting queries over the alert table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.functions.times import parse_time
from ringwatch.schemas import CONFIRMED

# Fixed values of the reports: lengths of the lists that are cut by design.
LATEST = 300
TOP_TOKENS = 10
DEFAULT_SEVERITIES = ("CRITICAL", "HIGH")
DISPLAY = [
    "detected_at", "alert_type", "severity", "confidence", "source", "social_edge_count",
    "hub_node", "node_count", "edge_density", "price_corroborated", "pumping_tokens",
]


def _newest(ties: list[str]):
    return [F.desc("detected_at"), *ties]


def latest_alerts(alerts: DataFrame, ties: list[str], n: int = LATEST) -> DataFrame:
    """The list of the newest ``n`` alerts; ``ties`` completes the order."""
    return alerts.orderBy(*_newest(ties)).limit(n)


def alert_kpis(alerts: DataFrame) -> DataFrame:
    """Totals over all alerts, 0 when there are none."""
    return alerts.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        F.count_if(F.col("severity") == "HIGH").alias("high"),
        F.count_if(F.col("alert_type") == CONFIRMED).alias("confirmed"),
    )


def alerts_timeline(alerts: DataFrame) -> DataFrame:
    """Alerts per minute and type; rows without a readable time are dropped."""
    at = F.col("detected_at")
    if dict(alerts.dtypes)["detected_at"] == "string":
        at = parse_time(at)
    timed = alerts.withColumn("detected_at", at).filter(F.col("detected_at").isNotNull())
    minute = F.window("detected_at", "1 minute")
    return timed.groupBy(minute.alias("w"), "alert_type").agg(F.count(F.lit(1)).alias("count")).select(
        F.col("w.start").alias("detected_at"), "alert_type", "count"
    )


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("alert_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "alert_type")
    )


def top_tokens(alerts: DataFrame, n: int = TOP_TOKENS) -> DataFrame:
    """The tokens named in most alerts; equal counts in name order."""
    tokens = alerts.select(F.explode("pumping_tokens").alias("token")).filter(F.length("token") > 0)
    return (
        tokens.groupBy("token")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy(F.desc("alert_count"), "token")
        .limit(n)
    )


def filter_alerts(
    alerts: DataFrame, severities: list[str] | None = None, types: list[str] | None = None
) -> DataFrame:
    """Alerts of the given severities and types; an empty choice does not filter."""
    for column, choice in (("severity", severities), ("alert_type", types)):
        if choice:
            alerts = alerts.filter(F.col(column).isin(list(choice)))
    return alerts


def display_columns(alerts: DataFrame) -> DataFrame:
    return alerts.select(*[c for c in DISPLAY if c in alerts.columns])


def alert_table(
    alerts: DataFrame,
    ties: list[str],
    severities: list[str] | None = DEFAULT_SEVERITIES,
    types: list[str] | None = None,
    n: int | None = None,
) -> DataFrame:
    """The alerts that pass the filters, newest first; with ``n`` the first so many of them."""
    kept = filter_alerts(alerts, severities, types).orderBy(*_newest(ties))
    return display_columns(kept if n is None else kept.limit(n))
