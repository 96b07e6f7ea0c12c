"""The detection job: every micro-batch is a batch of the detectors."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ringwatch.operators.alerts import detect
from ringwatch.operators.batches import batch_outcomes, batch_status
from ringwatch.operators.quality import (
    batch_epochs, count_outcomes, running_quality, stored_snapshot, with_scores,
)
from ringwatch.params import DEFAULTS, Params
from ringwatch.schemas import ALERT, OUTCOME
from ringwatch.session import Scratch
from ringwatch.sinks import tables
from ringwatch.sinks.tables import Folder, close_blocks, closed_blocks, read_table, write_batch
from ringwatch.sources.events import in_order_of_arrival

# Fixed value: seconds between batches.
TRIGGER = "10 seconds"
KEY = "batch_id"


def alerts_path(out: str) -> str:
    return f"{out.rstrip('/')}/alerts"


def outcomes_path(out: str) -> str:
    return f"{out.rstrip('/')}/outcomes"


def make_batch_writer(
    out: str,
    params: Params = DEFAULTS,
    seq: list[str] | None = None,
    detected_at: Column | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: detects, and replaces the batch in both tables.

    The batch's decoded events are written down once, with their order of arrival
    (the place in the source, where the stream has it) unless ``seq`` names columns that give it; everything else reads that table.
    Alerts of the batch and one outcome row per non-empty batch are stored; a trigger
    without events stores nothing of either. Intermediate tables are dropped at the end.
    """

    def write(events: DataFrame, batch_id: int) -> None:
        scratch = Scratch(events.sparkSession)
        try:
            arrived = in_order_of_arrival(events, "_arrival")
            kept = scratch.cut(arrived.withColumn(KEY, F.lit(batch_id).cast("bigint")), "events")
            found = detect(kept, [KEY], seq or ["_arrival"], params, detected_at, scratch=scratch)
            write_batch(found.alerts, alerts_path(out), batch_id)
            carry = ["social_count", "price_count", "alert_count", "confidence"]
            write_batch(batch_outcomes(found.scored, [KEY], carry), outcomes_path(out), batch_id)
        finally:
            scratch.drop()
        close_past_blocks(events.sparkSession, out, batch_id)

    return write


def close_past_blocks(spark: SparkSession, out: str, batch_id: int) -> None:
    """Merge the blocks that ``batch_id`` has left behind, and keep their counters.

    A batch of a closed block that is written again is merged again, which repairs the block's counters.
    """
    closed = closed_blocks(spark, outcomes_path(out))
    before = max([batch_id // tables.BLOCK, *(b + 1 for b in closed)])
    changed = close_blocks(spark, outcomes_path(out), OUTCOME, before)
    close_blocks(spark, alerts_path(out), ALERT, before)
    counted = Folder(spark, totals_path(out))
    missing = set(closed_blocks(spark, outcomes_path(out))) - {r.block for r in _totals(spark, out).select("block").collect()}
    fresh = sorted(missing | set(changed))
    if fresh:
        rows = read_table(spark, outcomes_path(out), OUTCOME, fresh)
        block = F.floor(F.col(KEY) / tables.BLOCK).cast("bigint").alias("block")
        added = count_outcomes(_with_epochs(spark, out, rows).withColumn("block", block), ["block", "epoch"])
        counted.replace(_totals(spark, out).filter(~F.col("block").isin(fresh)).unionByName(added))


def start_detection(
    events: DataFrame, out: str, checkpoint: str, params: Params = DEFAULTS, once: bool = False, **options
) -> StreamingQuery:
    """Run the job on a stream of decoded events.

    ``checkpoint`` keeps the offsets; together with the replaced batches a restart
    neither loses nor repeats an alert. ``once`` drains what is there and ends.
    """
    writer = events.writeStream.foreachBatch(make_batch_writer(out, params, **options))
    writer = writer.option("checkpointLocation", checkpoint).queryName("ring-detection")
    trigger = {"availableNow": True} if once else {"processingTime": TRIGGER}
    return writer.trigger(**trigger).start()


def stored_alerts(spark: SparkSession, out: str) -> DataFrame:
    """All alerts so far, for the reports."""
    return read_table(spark, alerts_path(out), ALERT)


def stored_outcomes(spark: SparkSession, out: str) -> DataFrame:
    return read_table(spark, outcomes_path(out), OUTCOME)


# Counters


def totals_path(out: str) -> str:
    return f"{out.rstrip('/')}/totals"


def resets_path(out: str) -> str:
    return f"{out.rstrip('/')}/resets"


TOTALS = (
    "block long, epoch long, true_positives long, false_positives long, false_negatives long, total_batches long"
)


def reset_metrics(spark: SparkSession, out: str, batch_id: int) -> None:
    """The counters start again with ``batch_id``, which must not have been run yet. Repeating a reset changes nothing."""
    marker = spark.createDataFrame([(batch_id,)], f"{KEY} long")
    marker.coalesce(1).write.mode("overwrite").parquet(f"{resets_path(out)}/at={batch_id}")


def stored_resets(spark: SparkSession, out: str) -> DataFrame:
    """The first batches after a reset: the names of the markers, one per reset."""
    at = Folder(spark, resets_path(out)).numbers("at")
    return spark.createDataFrame([(n,) for n in at], f"{KEY} long")


def _with_epochs(spark: SparkSession, out: str, outcomes: DataFrame) -> DataFrame:
    return batch_epochs(outcomes, stored_resets(spark, out), KEY)


def _totals(spark: SparkSession, out: str) -> DataFrame:
    """Counters of every closed block and epoch."""
    latest = Folder(spark, totals_path(out)).latest()
    return spark.read.schema(TOTALS).parquet(latest) if latest else spark.createDataFrame([], TOTALS)


def metrics_over_batches(spark: SparkSession, out: str) -> DataFrame:
    """Running precision, recall and F1 after every batch since the reset before it, from the stored outcomes.

    Nothing is kept in memory, so a restart or a repeated batch changes nothing.
    """
    return running_quality(_with_epochs(spark, out, stored_outcomes(spark, out)), KEY, "epoch").drop("epoch")


def current_metrics(spark: SparkSession, out: str) -> DataFrame:
    """One row over all batches since the last reset.

    Closed blocks are known by their counters, one file for all; only the batches of open blocks are read.
    """
    blocks = Folder(spark, outcomes_path(out)).numbers("block")
    still_open = read_table(spark, outcomes_path(out), OUTCOME, blocks)
    resets = Folder(spark, resets_path(out)).numbers("at")
    epoch = F.lit(resets[-1] if resets else None).cast("bigint")
    recent = count_outcomes(still_open.filter(F.col(KEY) >= F.coalesce(epoch, F.lit(0))))
    names = recent.columns
    past = _totals(spark, out).filter(~F.col("block").isin(blocks) & F.col("epoch").eqNullSafe(epoch)).select(names)
    both = past.unionByName(recent)
    return with_scores(both.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]))


def status_lines(spark: SparkSession, out: str) -> DataFrame:
    """What each batch found and the metrics after it, as one line."""
    return batch_status(stored_outcomes(spark, out), metrics_over_batches(spark, out), [KEY])


def last_stored_metrics(spark: SparkSession, out: str) -> DataFrame:
    """The metrics as of the last batch with an alert or a pumping price."""
    return stored_snapshot(metrics_over_batches(spark, out), KEY)
