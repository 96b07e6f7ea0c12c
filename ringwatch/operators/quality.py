"""Detection quality over the sequence of batches."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.scan import as_of, running_sums
from ringwatch.session import Scratch, scratch_for

_COUNTS = {
    "true_positives": "TP",
    "false_positives": "FP",
    "false_negatives": "FN",
}


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def with_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 to three digits; F1 is of the unrounded two."""
    tp = F.col("true_positives")
    precision = _ratio(tp, tp + F.col("false_positives"))
    recall = _ratio(tp, tp + F.col("false_negatives"))
    exact = counts.withColumn("_p", precision).withColumn("_r", recall)
    f1 = _ratio(2 * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r"))
    return exact.select(
        *counts.columns,
        F.round("_p", 3).alias("precision"),
        F.round("_r", 3).alias("recall"),
        F.round(f1, 3).alias("f1_score"),
    )


def _flags() -> dict[str, Column]:
    ones = {
        name: F.when(F.col("outcome") == code, 1).otherwise(0).cast("bigint") for name, code in _COUNTS.items()
    }
    return {**ones, "total_batches": F.lit(1).cast("bigint")}


def count_outcomes(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The four counters over all rows, or over those of each group ``by``."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in _flags().items()]
    return outcomes.groupBy(*(by or [])).agg(*sums)


def running_quality(
    outcomes: DataFrame, order: str, epoch: str | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """Counters and scores after each batch, in batch order.

    A new ``epoch`` value starts the counters again. The running sums are taken in ranges of
    the order column, of any type, plus the totals of the ranges before. Batches
    without an order value come first.
    """
    scratch = scratch_for(outcomes, scratch)
    return with_scores(running_sums(outcomes, [epoch] if epoch else [], [order], _flags(), scratch))


def batch_epochs(outcomes: DataFrame, markers: DataFrame, order: str, out: str = "epoch", scratch: Scratch | None = None) -> DataFrame:
    """Outcomes with the reset they come after: the last marker ``order`` at or before the batch; null before the first.

    A marker says that the counters start again with the first batch at or after it.
    """
    marks = markers.select(order, F.col(order).alias("_reset"))
    return as_of(outcomes, marks, order, "_reset", out, scratch=scratch)


def quality_snapshot(outcomes: DataFrame) -> DataFrame:
    """Counters and scores after the last batch: seven fields, one row."""
    return with_scores(count_outcomes(outcomes))


def stored_snapshot(quality: DataFrame, order: str, updated_at: Column | None = None) -> DataFrame:
    """The snapshot as last written: that of the latest batch that stored anything.

    Batches without alert or pumping price store nothing, so this one can lag
    behind the true counters.
    """
    when = F.current_timestamp() if updated_at is None else updated_at
    return (
        quality.filter("persisted")
        .orderBy(F.desc(order))
        .limit(1)
        .select(
            "precision", "recall", "f1_score", *_COUNTS, "total_batches", when.alias("updated_at")
        )
    )


def quality_gauges(snapshot: DataFrame) -> DataFrame:
    """Gauge values in percent, and the precision card with one digit."""
    names = ["precision", "recall", "f1_score"]
    return snapshot.select(
        *snapshot.columns,
        *[(F.col(n) * 100).alias(f"{n}_pct") for n in names],
        F.format_string("%.1f%%", F.col("precision") * 100).alias("precision_card"),
    )
