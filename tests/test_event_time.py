import json
import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ringwatch.operators import alerts, polls
from ringwatch.params import Params
from ringwatch.schemas import EVENT
from ringwatch.sources import events as E
from ringwatch.streaming import windows
from ringwatch.streaming.polls import STATE_STORE, ordered_poll_changes

PARAMS = Params(star_min_degree=6, ring_min_size=4, ring_density=0.6)
DAY0 = datetime(2024, 1, 1)


def put(folder, number, rows):
    folder.mkdir(exist_ok=True)
    file = folder / f"{number:03}.json"
    file.write_text("".join(json.dumps(r) + "\n" for r in rows))
    os.utime(file, (1.7e9 + number, 1.7e9 + number))


def social(day, minute, src, dst, **more):
    at = DAY0 + timedelta(days=day, minutes=minute)
    return {"event_type": "social_interaction", "source_user": src, "target_user": dst, "timestamp": at.isoformat(), **more}


def price(day, minute, symbol, pumping):
    at = DAY0 + timedelta(days=day, minutes=minute)
    return {"event_type": "price_candle", "symbol": symbol, "pumping": pumping, "timestamp": at.isoformat()}


def one_day(day, draw):
    rows = [social(day, 5 * i, f"hub{day}", f"leaf{i}", is_bot=i % 2 == 0, pump_signal=True) for i in range(7)]
    members = [f"m{day}_{i}" for i in range(5)]
    rows += [social(day, 100 + i, a, b) for i, (a, b) in enumerate((a, b) for a in members for b in members if a < b)]
    rows += [social(day, 300, f"x{draw.random()}", "y"), social(day, 301, "", "y"), {"event_type": None, "timestamp": None}]
    rows += [price(day, 20, "BTC", day % 2 == 0), price(day, 21, "ETH", False), price(day, 22, "BTC", day % 2 == 0)]
    draw.shuffle(rows)
    return rows


def plain(rows):
    keep = ["window_start", "alert_type", "severity", "confidence", "price_corroborated", "pumping_tokens", "social_edge_count",
            "gt_bot_ratio", "detected_at", "hub_node", "out_degree", "out_ratio", "seed_node", "nodes", "node_count", "edge_density", "social_alerts"]
    return sorted(str([r[c] for c in keep]) for r in rows)


def test_window_alerts_equal_the_batch_form(spark, tmp_path):
    draw, folder, out, checkpoint = random.Random(1), tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    kept, late = [], [social(0, 50 + i, "latecomer", f"z{i}") for i in range(9)]

    def drain():
        stream = E.decode(E.read_file_stream(spark, str(folder), 1))
        windows.start_window_detection(stream, out, checkpoint, "1 day", "2 hours", params=PARAMS, once=True).awaitTermination()
        return windows.stored_window_alerts(spark, out).collect()

    for day in range(3):  # half of each day's rows come with the next day's, within the delay
        rows = one_day(day, draw)
        kept += rows
        early = [r for r in rows if (r["timestamp"] or "") < (DAY0 + timedelta(days=day, hours=2)).isoformat()]
        put(folder, 2 * day, early)
        put(folder, 2 * day + 1, [r for r in rows if r not in early])
    first = drain()
    put(folder, 10, [social(4, 0, "a", "b")])  # closes days 0 to 2
    put(folder, 11, late)  # comes for a closed window
    put(folder, 12, one := one_day(5, draw))
    put(folder, 13, [social(9, 0, "a", "b")])
    put(folder, 14, [social(9, 1, "a", "b")])
    kept += [social(4, 0, "a", "b"), *one]
    found = drain()  # after a restart
    assert plain(first) == plain([r for r in found if r.window_start < DAY0 + timedelta(days=len({f.window_start for f in first}))])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT)
    batch = spark.read.schema(fields).json(spark.sparkContext.parallelize(list(map(json.dumps, kept))))
    batch = E.with_event_time(batch).filter("event_time IS NOT NULL")
    window = F.window("event_time", "1 day")
    batch = batch.select("*", window.start.alias("window_start"), window.end.alias("window_end"))
    same = alerts.detect(
        batch, ["window_start", "window_end"], ["event_time", "source_user", "target_user"], PARAMS, F.col("_batch.window_end")
    )
    wanted = same.alerts.collect()
    assert plain(found) == plain(wanted)
    kinds = {(r.window_start, r.alert_type) for r in found}
    assert {k for _, k in kinds} == {"STAR_TOPOLOGY", "CLIQUE_DETECTED", "PUMP_AND_DUMP_CONFIRMED"}
    assert not any(r.hub_node == "latecomer" for r in found)
    outcomes = windows.stored_window_outcomes(spark, out).collect()
    assert sorted((r.window_start, r.outcome) for r in outcomes) == sorted(
        (r.window_start, "TP" if r.ground_truth and r.alert_count else "FP" if r.alert_count else "FN" if r.ground_truth else "TN")
        for r in same.scored.collect()
    )


def test_a_repeated_window_batch_replaces_itself(spark, tmp_path):
    rows = [social(0, i, "h", f"l{i}") for i in range(8)]
    put(tmp_path / "in", 0, rows)
    parts = windows.window_parts(E.decode(spark.read.text(str(tmp_path / "in"))), "1 day", "1 hour")
    write = windows.make_window_writer(str(tmp_path / "out"), PARAMS)
    for _ in range(2):
        write(parts, 3)
    assert [r.hub_node for r in windows.stored_window_alerts(spark, str(tmp_path / "out")).collect()] == ["h"]


def run_polls(spark, folder, checkpoint, name, **options):
    schema = "token string, poll_ts timestamp, price_usd double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    changes = ordered_poll_changes(stream, "10 minutes", **options)
    query = changes.writeStream.format("parquet").option("path", str(checkpoint) + "-out").option("checkpointLocation", str(checkpoint))
    query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(changes.schema).parquet(str(checkpoint) + "-out")


def poll(token, seconds, value):
    return {"token": token, "poll_ts": (DAY0 + timedelta(seconds=seconds)).isoformat(), "price_usd": value}


COLUMNS = ["token", "poll_ts", "price_usd", "previous_price", "change_since_last_poll_pct", "pumping"]


def test_polls_in_any_order_equal_the_batch_form(spark, tmp_path):
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    draw = random.Random(2)
    rows = [poll(draw.choice(["a", "b", None]), s, draw.choice([1.0, 1.01, 2.0, 0.0, None])) for s in range(0, 7200, 7)]
    rows += [poll("busy", s % 600, 1.0 + s % 5) for s in range(2000)]  # many polls of one time
    rows.sort(key=lambda r: (datetime.fromisoformat(r["poll_ts"]) + timedelta(seconds=draw.randrange(540))).isoformat())
    parts = [rows[i::1][:0] or rows[i : i + 700] for i in range(0, len(rows), 700)]
    for i, part in enumerate(parts[:3]):
        put(tmp_path / "in", i, part)
    run_polls(spark, tmp_path / "in", tmp_path / "cp", "p1")
    for i, part in enumerate(parts[3:], 3):
        put(tmp_path / "in", i, part)
    put(tmp_path / "in", 90, [poll("end", 100_000, 1.0)])
    put(tmp_path / "in", 91, [poll("end", 100_001, 1.0), poll("a", 5, 77.0)])  # the second is late
    found = run_polls(spark, tmp_path / "in", tmp_path / "cp", "p2").select(COLUMNS)
    frame = spark.createDataFrame(
        [(r["token"], datetime.fromisoformat(r["poll_ts"]), r["price_usd"]) for r in rows], "token string, poll_ts timestamp, price_usd double"
    )
    wanted = polls.poll_changes(frame).select(COLUMNS)
    key = lambda r: str(tuple(r))
    got = sorted((r for r in found.collect() if r.token != "end"), key=key)
    batch = sorted((r.asDict() | {"price_usd": r.price_usd or 0.0} for r in wanted.collect()), key=lambda d: str(tuple(d.values())))
    assert [r.asDict() for r in got] == batch


def test_a_silent_token_is_forgotten(spark, tmp_path):
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    put(tmp_path / "in", 0, [poll("a", 0, 1.0), poll("a", 30, 2.0)])
    put(tmp_path / "in", 1, [poll("z", 4000, 1.0)])
    put(tmp_path / "in", 2, [poll("z", 8000, 1.0)])
    put(tmp_path / "in", 3, [poll("a", 8000, 9.0)])
    put(tmp_path / "in", 4, [poll("z", 20000, 1.0)])
    put(tmp_path / "in", 5, [poll("z", 20001, 1.0)])
    found = run_polls(spark, tmp_path / "in", tmp_path / "cp", "f", forget_seconds=600).filter("token = 'a'").orderBy("poll_ts").collect()
    assert [(r.price_usd, r.previous_price) for r in found] == [(1.0, 1.0), (2.0, 1.0), (9.0, 9.0)]
