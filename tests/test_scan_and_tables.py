import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ringwatch.functions.times import parse_time
from ringwatch.operators import polls, quality
from ringwatch.operators.scan import as_of
from ringwatch.schemas import OUTCOME
from ringwatch.session import Scratch
from ringwatch.sinks import tables
from ringwatch.streaming import detection

ORDERS = {
    "long": lambda n: n, "double": lambda n: n / 3, "string": lambda n: f"{n:05}", "decimal(20,2)": lambda n: Decimal(n),
    "timestamp": lambda n: datetime(2024, 1, 1) + timedelta(microseconds=n), "date": lambda n: date(2024, 1, 1) + timedelta(days=n),
}


@pytest.mark.parametrize("kind", ORDERS)
def test_poll_changes_over_any_order(spark, kind):
    draw = random.Random(3)
    rows = [(draw.choice(["a", "b", None]), ORDERS[kind](n), float(draw.randrange(1, 9))) for n in range(300)]
    rows += [("a", None, 4.0)]
    draw.shuffle(rows)
    found = polls.poll_changes(spark.createDataFrame(rows, f"token string, poll_ts {kind}, price_usd double")).collect()
    for token in ("a", "b", None):
        series = sorted((r for r in rows if r[0] == token), key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0))
        wanted = [(r[1], r[2], series[max(i - 1, 0)][2]) for i, r in enumerate(series)]
        got = [(r.poll_ts, r.price_usd, r.previous_price) for r in found if r.token == token]
        assert sorted(got, key=str) == sorted(wanted, key=str)


def test_a_hot_day_spreads_over_tasks(spark):
    day = spark.range(20_000).select(
        F.lit("t").alias("token"), (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=F.col("id") % 5000)).alias("poll_ts"),
        (F.col("id") % 17).cast("double").alias("price_usd"),
    )
    found = polls.poll_changes(day)
    tasks = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 3 and max(r["count"] for r in tasks) < 10_000


def test_as_of_against_brute_force(spark):
    draw = random.Random(4)
    rows = [(n, draw.choice(["x", "y", None]), draw.choice([None, *range(200)])) for n in range(400)]
    marks = [(draw.choice(["x", "y", "z", None]), draw.randrange(200), draw.randrange(9)) for _ in range(25)]
    found = as_of(
        spark.createDataFrame(rows, "id long, s string, at long"), spark.createDataFrame(marks, "s string, at long, v int"), "at", "v", "seen", ["s"]
    ).collect()
    assert len(found) == len(rows)
    for r in found:
        before = [(a, v) for s, a, v in marks if s == r.s and r.at is not None and a <= r.at]
        assert r.seen == (max(before)[1] if before else None)
    assert as_of(spark.createDataFrame(rows, "id long, s string, at long"), spark.createDataFrame([], "at long, v int"), "at", "v", "o").filter("o IS NULL").count() == 400


def outcome(spark, kind):
    row = (kind in ("TP", "FN"), kind in ("TP", "FP"), kind, True, 1, 1, 1, "LOW")
    return spark.createDataFrame([row], OUTCOME).coalesce(1)


def write(spark, out, n, kind):
    tables.write_batch(outcome(spark, kind) if kind else spark.createDataFrame([], OUTCOME), detection.outcomes_path(out), n)
    tables.write_batch(spark.createDataFrame([], detection.ALERT), detection.alerts_path(out), n)
    detection.close_past_blocks(spark, out, n)


def counters(kinds):
    return tuple(sum(k == c for k in kinds) for c in ("TP", "FP", "FN")) + (len(kinds),)


def current(spark, out):
    r = detection.current_metrics(spark, out).first()
    return r.true_positives, r.false_positives, r.false_negatives, r.total_batches


def test_blocks_are_closed_and_repaired(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BLOCK", 4)
    draw, out = random.Random(5), str(tmp_path)
    kinds = {}
    for n in range(18):
        kinds[n] = draw.choice(["TP", "FP", "FN", "TN"])
        write(spark, out, n, kinds[n])
    assert tables.closed_blocks(spark, detection.outcomes_path(out)) == [0, 1, 2, 3]
    assert current(spark, out) == counters(kinds.values())
    stored = detection.stored_outcomes(spark, out)
    assert {r.batch_id: r.outcome for r in stored.collect()} == kinds and stored.count() == 18
    assert len(stored.inputFiles()) <= 4 + 2 and len(detection.current_metrics(spark, out).inputFiles()) <= 1 + 2
    for n, kind in ((5, "TP"), (6, None), (17, "FN"), (15, "FP")):  # batches of closed blocks come again
        write(spark, out, n, kind)
        kinds[n] = kind
        if not kind:
            del kinds[n]
        assert current(spark, out) == counters(kinds.values())
        assert {r.batch_id: r.outcome for r in detection.stored_outcomes(spark, out).collect()} == kinds
    assert tables.read_batch(spark, detection.outcomes_path(out), OUTCOME, 5).first().outcome == "TP"
    assert tables.read_batch(spark, detection.outcomes_path(out), OUTCOME, 6).count() == 0


def test_half_done_merges_are_not_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BLOCK", 2)
    out, path = str(tmp_path), detection.outcomes_path(str(tmp_path))
    for n in range(5):
        write(spark, out, n, "TP")
    # A merge whose driver was lost: the open folders of a closed block are still there, and a draft.
    tables.write_batch(outcome(spark, "FP"), path, 1)
    outcome(spark, "FN").write.parquet(f"{path}_closed/block=0/_draft-1")
    outcome(spark, "FN").write.parquet(f"{path}_closed/block=0/version=9")
    (tmp_path / "outcomes_closed" / "block=0" / "version=9" / "_SUCCESS").unlink()
    assert sorted(r.outcome for r in detection.stored_outcomes(spark, out).collect()) == ["FP"] + ["TP"] * 4
    assert current(spark, out) == (4, 1, 0, 5)
    write(spark, out, 5, "TN")
    assert current(spark, out) == (4, 1, 0, 6)


def test_resets_start_the_counters_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BLOCK", 3)
    out, kinds = str(tmp_path), ["TP", "FP", "FN", "TP", "TP", "FP", "TN", "TP", "FN", "FP"]
    starts = [0]
    for n, kind in enumerate(kinds):
        if n in (2, 6):
            detection.reset_metrics(spark, out, n)
            detection.reset_metrics(spark, out, n)
            starts.append(n)
            assert current(spark, out) == (0, 0, 0, 0)
        write(spark, out, n, kind)
        assert current(spark, out) == counters(kinds[starts[-1] : n + 1])
    running = detection.metrics_over_batches(spark, out).orderBy("batch_id").collect()
    for n, r in enumerate(running):
        start = max(s for s in (0, 2, 6) if s <= n)
        assert (r.true_positives, r.false_positives, r.false_negatives, r.total_batches) == counters(kinds[start : n + 1])


def test_running_quality_over_text_order(spark):
    rows = [(f"k{n:03}", "TP" if n % 3 else "FP") for n in range(100)]
    found = quality.running_quality(spark.createDataFrame(rows, "k string, outcome string").repartition(5), "k", scratch=Scratch(spark))
    for r in found.collect():
        n = int(r.k[1:]) + 1
        assert (r.total_batches, r.false_positives) == (n, (n + 2) // 3)


@pytest.mark.parametrize("text,wanted", [
    ("2024-03-05T06:07:08", "2024-03-05 06:07:08"), ("2024-03-05", "2024-03-05 00:00:00"), ("3/5/2024 6:07", "2024-03-05 06:07:00"),
    ("Tue Mar 05 06:07:08 +0000 2024", "2024-03-05 06:07:08"), ("05.03.2024", "2024-03-05 00:00:00"), ("5 Mar 2024 06:07:08", "2024-03-05 06:07:08"),
    ("Mar 5, 2024", "2024-03-05 00:00:00"), ("2024/3/5", "2024-03-05 00:00:00"), ("25/12/2024", None), ("soon", None), ("", None), (None, None),
    ("20240305", "2024-03-05 00:00:00"), ("2024-03-05T06:07:08+02:00", "2024-03-05 04:07:08"),
])
def test_time_layouts(spark, text, wanted):
    found = spark.createDataFrame([(text,)], "t string").select(F.date_format(parse_time(F.col("t")), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert found == wanted
