import pytest
from pyspark.sql import functions as F

from ringwatch.functions import text as T
from ringwatch.functions.prices import body_pct, is_body_pump
from ringwatch.sinks.topics import topic_records
from ringwatch.plans import adapters
from ringwatch.sources import csvfiles, events, ohlcv, snapshots, stats, tweets


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression).first()[0]


@pytest.mark.parametrize("text,names", [
    ("hi @bob, @a @carol @bob,", ["bob,", "carol", "bob,"]), ("none", []), ("", []), (None, None),
    ("@one @two @three @four", ["one", "two", "thr" + "ee", "four"]),
])
def test_mentions(spark, text, names):
    assert one(spark, T.at_mentions(F.col("x")), text) == names


def test_tokens(spark):
    text = "buy $BTC and the ETH! btc X LONGESTWORD sol ada xrp dot"
    assert one(spark, T.token_mentions(F.col("x")), text) == ["BUY", "BTC", "ETH", "SOL", "ADA", "XRP", "DOT"]
    assert one(spark, T.token_mentions(F.col("x"), 5), text) == ["BUY", "BTC", "ETH", "SOL", "ADA"]
    assert one(spark, T.first_token(F.col("x")), "the a") is None


def test_edges_of_posts(spark):
    rows = [("u" * 40, "@aa @bb @cc @dd buy", "d"), ("v", "nothing", "d"), (None, None, None)]
    df = spark.createDataFrame(rows, "user string, text string, date string")
    full = tweets.tweets_to_interactions(df).collect()
    assert [r.target_user for r in full[:4]] == ["tw_aa", "tw_bb", "tw_cc", "tw_dd"]
    assert full[0].source_user == "tw_" + "u" * 40
    assert full[4].target_user == "tw_crypto_community"
    cut = tweets.tweets_to_interactions(df, max_mentions=3, max_name=30).collect()
    assert len([r for r in cut if r.source_user == "tw_" + "u" * 30]) == 3


@pytest.mark.parametrize("open_,close,flag", [
    (100.0, 110.0, False), (100.0, 110.01, True), (100.0, 89.0, True), (0.0, 5.0, False), (float("nan"), 5.0, False),
])
def test_body(spark, open_, close, flag):
    df = spark.createDataFrame([(open_, close)], "o double, c double")
    assert df.select(is_body_pump(F.col("o"), F.col("c"))).first()[0] is flag
    assert df.select(body_pct(F.col("o"), F.col("c"))).first()[0] >= 0


@pytest.mark.parametrize("columns,user,text", [
    (["user_name", "text", "date"], "user_name", "text"), (["author", "content", "created"], "author", "content"),
    (["id", "likes"], None, None), (["user", "tweet"], "user", "tweet"),
    (["user_id", "username", "text"], "username", "text"),
])
def test_roles(columns, user, text):
    found = tweets.infer_roles(columns)
    assert (found["user"], found["text"]) == (user, text)


def test_malformed_tweet_lines_go(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'user_name,text,date\nann,hello @bob,d1\nbad,too,many,cells\nshort\nkim,"two\nlines, quoted",d2\n'
    )
    (tmp_path / "b.csv").write_text("Tweet,likes\nno user here,3\nno user here,3\n")
    (tmp_path / "c.csv").write_text("id,likes\n1,2\n")
    (tmp_path / "d.csv").write_text("\n")
    paths = csvfiles.list_inputs(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a.csv", "b.csv", "c.csv", "d.csv"]
    posts = tweets.read_tweets(spark, paths)
    rows = posts.collect()
    assert posts.count() == len(rows) == 4
    users = sorted(r.user for r in rows)
    assert users[:2] == ["ann", "kim"] and len(set(users)) == 4
    assert sorted(r.user for r in tweets.read_tweets(spark, paths).collect()) == users
    assert posts.select("user").count() == 4 and len(posts.select("user").collect()) == 4
    edges = tweets.tweets_to_interactions(posts)
    assert {(r.source_user, r.target_user) for r in edges.collect() if r.source_user == "tw_ann"} == {("tw_ann", "tw_bob")}


def test_inputs_fall_back_to_the_single_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    assert csvfiles.list_inputs(spark, str(tmp_path / "absent"), str(tmp_path / "one.csv"))[0].endswith("one.csv")
    assert csvfiles.list_inputs(spark, str(tmp_path / "absent")) == []


def test_candles(spark, tmp_path):
    (tmp_path / "coin_Foo_price.csv").write_text("Date,Open Price,High,Low,Close,Volume 24h\nd1,100,120,90,112,5\nd2,,1,1,1,1\nd3,x,1,1,1,1\n")
    (tmp_path / "coin_Bar.csv").write_text("Symbol,time,open,close,volume\nbar,t1,100,105,7\n,t2,0,9,7\n")
    found = ohlcv.to_candles(ohlcv.read_ohlcv(spark, csvfiles.list_inputs(spark, str(tmp_path))))
    rows = {(r.symbol, r.timestamp): r for r in found.collect()}
    assert set(rows) == {("FOO", "d1"), ("FOO", "d2"), ("BAR", "t1"), ("BAR", "t2")}
    assert rows["FOO", "d1"].pumping and rows["FOO", "d1"].volume == 5.0
    assert rows["FOO", "d2"].open is None and not rows["FOO", "d2"].pumping
    assert not rows["BAR", "t2"].pumping


def test_statistics(spark, tmp_path):
    (tmp_path / "coin_x_price.csv").write_text("a\n1\n2\n")
    (tmp_path / "y.csv").write_text("a\n")
    paths = csvfiles.list_inputs(spark, str(tmp_path))
    row = stats.csv_stats(spark, paths, "prices").first()
    assert (row.n_files, row.n_rows) == (2, 2) and row.mb > 0
    assert [r.coin for r in stats.coin_labels(spark, paths).orderBy("position").collect()] == ["COIN_X", "Y"]


def test_decode_and_topic(spark):
    good = '{"event_type": "price_candle", "symbol": "BTC", "pumping": true, "close": NaN}'
    raw = spark.createDataFrame([(good,), ("{broken",)], "value string")
    rows = events.decode(raw).collect()
    assert (rows[0].symbol, rows[0].pumping) == ("BTC", True) and rows[1].event_type is None
    record = topic_records(events.decode(raw), F.col("source_user")).first()
    assert record.key == "" and '"source_user":null' in record.value


def test_snapshots(spark):
    df = spark.createDataFrame([('{"shiba-inu": {"usd": 1.5}}', 1)], "document string, poll_ts long")
    row = snapshots.flatten_snapshots(df).first()
    assert (row.symbol, row.price_usd, row.volume_24h_usd, row.change_24h_pct) == ("SHIBA_INU", 1.5, 0.0, 0.0)


def test_kafka_options():
    assert events.kafka_options("h:1")["startingOffsets"] == "earliest"
    assert events.kafka_options("h:1", "a,b")["subscribe"] == "a,b"


def test_a_null_label_never_erases_a_post(spark, tmp_path):
    rows = [(0, "go $BTC @bob", "en", "web"), (3, "go $BTC @bob", None, "web"), (6, "go $BTC @bob", "en", None),
            (9, "go $BTC @bob", None, None), (12, None, "en", "web"), (1, "go", None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.text for r in adapters.posts(spark, str(tmp_path)).collect()}
    text = "go $BTC @bob"
    assert found == {0: f"@web @en {text}", 3: f"@web {text}", 6: f"@en {text}", 9: text, 12: None, 1: "go"}
