"""Event-time windows: the batch operators with a watermark instead of an arrival batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ringwatch.operators.alerts import BATCH, Detection, detect_links
from ringwatch.operators.batches import batch_outcomes, batch_summary, part_counts, pumping_symbol, summary_of_parts
from ringwatch.operators.graph import compact_links, detect_stars, interaction_edges
from ringwatch.params import DEFAULTS, Params
from ringwatch.schemas import ALERT, OUTCOME, SOCIAL_EVENT
from ringwatch.session import Scratch, scratch_for
from ringwatch.sinks.tables import read_table, write_batch
from ringwatch.sources.events import with_event_time

WINDOW = "window"
START = "window_start"


def windowed(events: DataFrame, width: str, delay: str, time: str = "event_time") -> DataFrame:
    """Events with their tumbling window; rows without a readable time are left out.

    A window closes once an event later than its end by ``delay`` has come. Rows that
    come for a closed window are dropped by the aggregations, as Spark counts in its
    query progress.
    """
    timed = events if time in events.columns else with_event_time(events)
    timed = timed.withColumn(time, F.col(time).cast("timestamp")).filter(F.col(time).isNotNull())
    return timed.withWatermark(time, delay).withColumn(WINDOW, F.window(time, width))


def windowed_summary(events: DataFrame, width: str, delay: str, time: str = "event_time") -> DataFrame:
    """One row per closed window, as ``batch_summary``."""
    return batch_summary(windowed(events, width, delay, time), [WINDOW])


def windowed_links(events: DataFrame, width: str, delay: str, time: str = "event_time") -> DataFrame:
    """Distinct links of every closed window."""
    edges = interaction_edges(windowed(events, width, delay, time), [WINDOW], [time])
    return compact_links(edges, [WINDOW])


def windowed_stars(
    events: DataFrame,
    width: str,
    delay: str,
    time: str = "event_time",
    min_degree: int = DEFAULTS.star_min_degree,
    degree_ratio: float = DEFAULTS.star_ratio,
) -> DataFrame:
    """Star alerts of every closed window."""
    edges = interaction_edges(windowed(events, width, delay, time), [WINDOW], [time])
    return detect_stars(edges, [WINDOW], min_degree, degree_ratio)


# Rings and confirmed alerts over event time


def window_parts(events: DataFrame, width: str, delay: str, time: str = "event_time") -> DataFrame:
    """What the detectors need of every closed window: its distinct links, its pumping symbols, and counts of both.

    This is the one stateful aggregation. All rows of a window have the same end, so they leave the state
    together, in the micro-batch in which the watermark passes it.
    """
    rows = windowed(events, width, delay, time)
    linked = F.col("event_type") == SOCIAL_EVENT
    linked = linked & (F.length("source_user") > 0) & (F.length("target_user") > 0)
    ends = [F.when(linked, F.col(c)).alias(n) for c, n in (("source_user", "src"), ("target_user", "dst"))]
    return rows.groupBy(WINDOW, *ends, pumping_symbol()).agg(F.min(time).alias("first_seen"), *part_counts())


def detect_windows(
    parts: DataFrame, params: Params = DEFAULTS, rings: bool = True, scratch: Scratch | None = None
) -> Detection:
    """``detect`` on the parts of whole windows: every window is a batch, keyed by ``window_start``.

    Links appear in the order of event time, those of one time in the order of their names. The end of
    a window is the time of its alerts, so they do not depend on when they are computed.
    """
    scratch = scratch_for(parts, scratch)
    key = F.struct(F.col(f"{WINDOW}.start").alias(START), F.col(f"{WINDOW}.end").alias("window_end"))
    parts = scratch.cut(parts.withColumn(BATCH, key).drop(WINDOW), "parts")
    edges = parts.filter("src IS NOT NULL").select(
        BATCH, "src", "dst", F.col("_rows").alias("n"), F.struct("first_seen", "src", "dst").alias("seq")
    )
    symbols = parts.groupBy(BATCH, "_symbol").agg(
        *[F.sum(c).alias(c) for c in ("_rows", "_social", "_price", "_edges", "_bots")],
        *[F.max(c).alias(c) for c in ("_pumping", "_truth")],
    )
    end = F.col(f"{BATCH}.window_end")
    found = detect_links(
        compact_links(edges, [BATCH]), summary_of_parts(symbols, [BATCH]), params, end, rings, scratch
    )
    return Detection(found.scored.drop("window_end"), found.alerts.drop("window_end"))


def window_alerts_path(out: str) -> str:
    return f"{out.rstrip('/')}/window_alerts"


def window_outcomes_path(out: str) -> str:
    return f"{out.rstrip('/')}/window_outcomes"


def make_window_writer(
    out: str, params: Params = DEFAULTS, rings: bool = True
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: detects in the windows that have just closed.

    A micro-batch that is run again replaces its own rows; a window closes only once.
    """

    def write(parts: DataFrame, batch_id: int) -> None:
        scratch = Scratch(parts.sparkSession)
        try:
            found = detect_windows(parts, params, rings, scratch)
            carry = ["social_count", "price_count", "alert_count", "confidence"]
            write_batch(found.alerts, window_alerts_path(out), batch_id)
            write_batch(batch_outcomes(found.scored, [START], carry), window_outcomes_path(out), batch_id)
        finally:
            scratch.drop()

    return write


def start_window_detection(
    events: DataFrame,
    out: str,
    checkpoint: str,
    width: str,
    delay: str,
    time: str = "event_time",
    params: Params = DEFAULTS,
    rings: bool = True,
    once: bool = False,
) -> StreamingQuery:
    """Stars, rings and confirmed alerts of every window that the watermark closes.

    The state holds open windows only: a row per link and symbol. Together with the offsets it is in
    ``checkpoint``, so a restart goes on with the windows that were open.
    """
    writer = window_parts(events, width, delay, time).writeStream.outputMode("append")
    writer = writer.foreachBatch(make_window_writer(out, params, rings)).queryName("window-detection")
    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _with_start(columns: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(START, T.TimestampType()), *columns.fields])


def stored_window_alerts(spark: SparkSession, out: str) -> DataFrame:
    return read_table(spark, window_alerts_path(out), _with_start(ALERT)).drop("batch_id")


def stored_window_outcomes(spark: SparkSession, out: str) -> DataFrame:
    return read_table(spark, window_outcomes_path(out), _with_start(OUTCOME)).drop("batch_id")
