import json
import os

from pyspark.sql import functions as F

from ringwatch.operators import alerts, polls
from ringwatch.operators.batches import batch_summary
from ringwatch.schemas import ALERT, EVENT
from ringwatch.sinks.tables import read_batch
from ringwatch.sources import events as E
from ringwatch.streaming import detection, progress, replay, spikes, windows


def star(hub, n, at):
    return [
        {"event_type": "social_interaction", "source_user": hub, "target_user": f"{hub}{i}", "is_bot": i % 2 == 0,
         "pump_signal": True, "timestamp": f"{at}T00:{i:02}:00"}
        for i in range(n)
    ]


def price(at, pumping=True):
    return [{"event_type": "price_candle", "symbol": "BTC", "pumping": pumping, "timestamp": f"{at}T01:00:00"}]


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    file = folder / name
    file.write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    # A file stream takes files by their time.
    os.utime(file, (1.7e9 + ord(name[0]), 1.7e9 + ord(name[0])))


def run(spark, folder, out, checkpoint):
    stream = E.decode(E.read_file_stream(spark, str(folder), 1))
    query = detection.start_detection(stream, str(out), str(checkpoint), once=True)
    query.awaitTermination()


def stored(spark, out):
    found = detection.stored_alerts(spark, str(out))
    return sorted((r.batch_id, r.alert_type, r.hub_node or "") for r in found.collect())


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    data, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    put(data, "a.json", star("h", 15, "2024-01-01") + price("2024-01-01"))
    put(data, "b.json", star("q", 4, "2024-01-02"))
    run(spark, data, out, checkpoint)
    first = [(0, "PUMP_AND_DUMP_CONFIRMED", ""), (0, "STAR_TOPOLOGY", "h")]
    assert stored(spark, out) == first
    put(data, "c.json", star("z", 12, "2024-01-03") + [{"event_type": None}])
    run(spark, data, out, checkpoint)
    assert stored(spark, out) == [*first, (2, "STAR_TOPOLOGY", "z")]
    metrics = detection.current_metrics(spark, str(out)).first()
    assert (metrics.total_batches, metrics.true_positives, metrics.false_negatives) == (3, 2, 1)
    assert [r.recall for r in detection.metrics_over_batches(spark, str(out)).orderBy("batch_id").collect()] == [1.0, 0.5, 0.667]
    lines = {r.batch_id: r.status for r in detection.status_lines(spark, str(out)).collect()}
    assert lines[1] == "[Batch 0001] [CLEAN] | social=4 price=0 | alerts=0 conf=MEDIUM | P=1.00 R=0.50 F1=0.67"
    assert read_batch(spark, detection.alerts_path(str(out)), ALERT, 2).count() == 1
    assert detection.last_stored_metrics(spark, str(out)).first().total_batches == 3
    rows = [{**r, "batch_id": b} for b, n in enumerate("abc") for r in map(json.loads, (data / f"{n}.json").read_text().split("\n")[:-1])]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT)
    batch = spark.read.schema(f"{fields}, batch_id long").json(spark.sparkContext.parallelize(map(json.dumps, rows)))
    same = alerts.detect(batch.withColumn("n", F.monotonically_increasing_id()), ["batch_id"], ["n"])
    assert sorted((r.batch_id, r.alert_type, r.hub_node or "") for r in same.alerts.collect()) == stored(spark, out)


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    write = detection.make_batch_writer(str(tmp_path / "out"))
    put(tmp_path / "in", "a.json", star("h", 15, "2024-01-01"))
    events = E.decode(spark.read.text(str(tmp_path / "in")))
    write(events, 1)
    write(events, 1)
    assert stored(spark, tmp_path / "out") == [(1, "STAR_TOPOLOGY", "h")]
    write(events.limit(0), 1)
    assert stored(spark, tmp_path / "out") == []
    assert detection.stored_outcomes(spark, str(tmp_path / "out")).count() == 0


def window_rows(spark, tmp_path, make):
    put(tmp_path / "in", "a.json", star("h", 12, "2024-01-01") + price("2024-01-01"))
    put(tmp_path / "in", "b.json", star("q", 3, "2024-01-03"))
    put(tmp_path / "in", "c.json", star("late", 20, "2024-01-01") + star("end", 1, "2024-01-20"))
    stream = E.decode(E.read_file_stream(spark, str(tmp_path / "in"), 1))
    query = make(stream).writeStream.format("memory").queryName(f"w{abs(hash(str(tmp_path)))}").outputMode("append")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(query.name).collect()


def test_windows_close_after_the_watermark(spark, tmp_path):
    rows = window_rows(spark, tmp_path, lambda s: windows.windowed_summary(s, "1 day", "1 hour"))
    got = {str(r.window.start)[:10]: (r.social_count, r.price_count, r.pumping_tokens) for r in rows}
    assert got["2024-01-03"] == (3, 0, []) and got["2024-01-01"][1:] == (1, ["BTC"])
    assert got["2024-01-01"][0] in (12, 32)  # late rows count only if the watermark had not yet moved


def test_windowed_stars(spark, tmp_path):
    rows = window_rows(spark, tmp_path, lambda s: windows.windowed_stars(s, "1 day", "1 hour"))
    assert "h" in {r.hub_node for r in rows} and "q" not in {r.hub_node for r in rows}


def test_window_batch_form_agrees(spark, tmp_path):
    put(tmp_path / "in", "a.json", star("h", 12, "2024-01-01") + star("q", 3, "2024-01-03"))
    events = E.decode(spark.read.text(str(tmp_path / "in")))
    found = batch_summary(windows.windowed(events, "1 day", "1 hour"), ["window"])
    assert sorted(r.social_count for r in found.collect()) == [3, 12]


def test_streaming_spikes_equal_batch(spark, tmp_path):
    steps = [("t", i, p) for i, p in enumerate([100.0, 100.2, 100.2, 0.0, 50.0])] + [("u", 0, 7.0), ("u", 3, 8.0)]
    for i in range(5):
        put(tmp_path / "in", f"{i}.json", [{"token": t, "poll_ts": n, "price_usd": p} for t, n, p in steps if n == i])
    schema = "token string, poll_ts long, price_usd double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = spikes.streaming_poll_changes(stream).writeStream.format("memory").queryName("spikes")
    query = query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    columns = ["token", "poll_ts", "price_usd", "previous_price", "change_since_last_poll_pct", "pumping"]
    got = sorted(map(tuple, spark.table("spikes").select(columns).collect()))
    batch = polls.poll_changes(spark.createDataFrame(steps, schema)).select(columns)
    assert got == sorted(map(tuple, batch.collect()))


def test_replay(spark, tmp_path):
    folder = tmp_path / "prices"
    folder.mkdir()
    (folder / "coin_foo.csv").write_text("Date,Open,Close\nd1,100,120\nd2,100,101\n")
    files = replay.stream_csv(spark, str(folder), ["Date", "Open", "Close"])
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    replay.write_records(replay.replay_candles(files), out, cp).awaitTermination()
    found = E.decode(replay.read_records(spark.read.text(out))).collect()
    assert sorted((r.key, r.symbol, r.timestamp, r.pumping) for r in found) == [("FOO", "FOO", "d1", True), ("FOO", "FOO", "d2", False)]
    posts = tmp_path / "posts"
    posts.mkdir()
    (posts / "p.csv").write_text("username,text,date\nann,@bob @cat go,d\n")
    files = replay.stream_csv(spark, str(posts), ["username", "text", "date"], multiline=True)
    out, cp = str(tmp_path / "out2"), str(tmp_path / "cp2")
    replay.write_records(replay.replay_tweets(files), out, cp).awaitTermination()
    found = E.decode(replay.read_records(spark.read.text(out))).collect()
    assert sorted((r.key, r.source_user, r.target_user) for r in found) == [("tw_ann", "tw_ann", "tw_bob"), ("tw_ann", "tw_ann", "tw_cat")]


def test_a_batch_in_other_splits_gives_equal_alerts(spark, tmp_path):
    """Two rings that share a node: which one is found depends on the order of arrival."""
    left, right = [f"l{i}" for i in range(4)] + ["mid"], ["mid"] + [f"r{i}" for i in range(4)]
    rows = [
        {"event_type": "social_interaction", "source_user": a, "target_user": b}
        for ring in (right, left) for i, a in enumerate(ring) for b in ring[i + 1 :]
    ]
    put(tmp_path / "in", "a.json", rows[:12])
    put(tmp_path / "in", "b.json", rows[12:])
    seen = set()
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for i, (most, cost) in enumerate(((200, 0), (700, 0), (1 << 20, 0), (90, 0), (4000, 1 << 20))):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(most))
        spark.conf.set("spark.sql.files.openCostInBytes", str(cost))
        out = tmp_path / f"out{i}"
        stream = E.decode(E.read_file_stream(spark, str(tmp_path / "in")))
        detection.start_detection(stream, str(out), str(tmp_path / f"cp{i}"), once=True).awaitTermination()
        found = detection.stored_alerts(spark, str(out)).collect()
        seen.add(str(sorted((r.seed_node, r.nodes, r.node_count) for r in found)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(seen) == 1 and "mid" in seen.pop()


def test_progress_without_further_jobs(spark, tmp_path):
    data, out = tmp_path / "in", tmp_path / "out"
    put(data, "a.json", star("h", 15, "2024-01-01") + price("2024-01-01"))
    (data / "b.json").write_text("{broken\n" + json.dumps(price("2024-01-02")[0]) + "\n{also broken\n")
    os.utime(data / "b.json", (1.7e9 + 99, 1.7e9 + 99))
    listener = progress.BatchProgress()
    spark.streams.addListener(listener)
    try:
        stream = progress.observed(E.decode(E.read_file_stream(spark, str(data), 1)))
        detection.start_detection(stream, str(out), str(tmp_path / "cp"), once=True).awaitTermination()
        batches = listener.wait_for("ring-detection", 2)
        late = progress.observed(E.decode(E.read_file_stream(spark, str(data), 1)))
        put(data, "c.json", star("z", 2, "2024-03-01"))
        put(data, "d.json", star("y", 3, "2024-01-01"))
        put(data, "e.json", star("x", 1, "2024-03-02"))
        windows.start_window_detection(late, str(out), str(tmp_path / "cp2"), "1 day", "1 hour", once=True).awaitTermination()
        found = listener.wait_for("window-detection", 5)
    finally:
        spark.streams.removeListener(listener)
    assert [(b["events"], b["social"], b["price"], b["malformed"]) for b in batches] == [(16, 15, 1, 0), (3, 0, 1, 2)]
    stored_rows = {r.batch_id: r for r in detection.stored_outcomes(spark, str(out)).collect()}
    assert {b["batch_id"]: (b["social"], b["price"]) for b in batches} == {n: (r.social_count, r.price_count) for n, r in stored_rows.items()}
    # The star's parts of the closed day: a row per link of three late ones.
    assert sum(b["late"] for b in found) == 3
