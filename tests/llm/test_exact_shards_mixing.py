import re
import zlib
from collections import Counter, defaultdict
from hashlib import md5, sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from ringwatch.llm import exact, mixing, queries, shards
from ringwatch.llm.common import single_spaced, word_count

SCHEMA = "doc_id long, text string, source string, kept string, _row string"
ROWS = [
    (1, "a b  c", "x", "k", "r"), (2, "a\tb\n c", "x", "k", "r"), (3, "a b c ", "y", "k", "r"), (4, None, None, "k", "r"),
    (5, "", "y", "k", "r"), (6, " ", "é", "k", "r"), (6, " ", "é", "k", "r"), (None, "a b c", "y", "k", "r"),
    (7, "w " * 5000, "y", "k", "r"), (8, "w " * 5000, "z", "k", "r"), (2, "a b c", "x", None, None),
]


def spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_single_spaced_and_words(spark):
    texts = ["", " ", "  ", "a b", " a", "a ", "a\x0b\x0cb", "a \t b", "\n\n", "a b  c", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(single_spaced(F.col("t")), word_count(F.col("t"))).collect()
    assert [r[0] for r in found] == [spaced(t) for t in texts]
    assert [r[1] for r in found] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_only_survivors_are_hashed(spark):
    """The bit map marks the groups it was made of, and hardly any other."""
    groups = spark.createDataFrame([(n, n * n - 7) for n in range(0, 3000, 3)], "_length int, _head long")
    rows = spark.createDataFrame([(n, n * n - 7) for n in range(3000)], "_length int, _head long")
    marked = exact._marked(rows, groups).filter("_open").select("_length").collect()
    assert {r[0] for r in marked} >= set(range(0, 3000, 3)) and len(marked) < 1010


@pytest.mark.parametrize("map_rows", [None, 1])
def test_exact_groups(spark, monkeypatch, map_rows):
    if map_rows:
        monkeypatch.setattr(exact, "MAP_ROWS", map_rows)
    df = spark.createDataFrame(ROWS, SCHEMA)
    digest = F.sha2(single_spaced(F.col("text")), 256)
    found = exact.exact_duplicates(df, carry={"h": digest}).collect()
    assert len(found) == len(ROWS)
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[sha256(spaced(t).encode()).hexdigest()].append(i)
    for r in found:
        ids = groups[r.h]
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None)
    kept = Counter(r.h for r in found if r.kept)
    assert kept == Counter(list(groups))
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_drop_keeps_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    left = exact.drop_exact_duplicates(df)
    assert left.columns == df.columns
    assert sorted(spaced(r.text) for r in left.collect()) == sorted({spaced(r[1]) for r in ROWS})
    assert exact.drop_exact_duplicates(df.limit(0)).count() == 0


def test_shards(spark):
    rows = [(i, f"text {i % 7} é") for i in range(3000)] + [(None, None), (5, "again"), (5, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    weights = [1.0] * 24
    found = shards.assign_shards(df, weights, weights + [1.0]).collect()
    assert len(found) == len(rows)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.grown_shard == r.shard or r.grown_shard == 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in found if r.doc_id == 5}) == 1
    moved = sum(r.grown_shard == 24 for r in found) / len(found)
    assert 0.02 < moved < 0.06
    texts = {i: t for i, t in rows if i != 5}
    for r in found:
        if r.doc_id != 5:
            t = texts[r.doc_id]
            assert r.size == 8 + len((t or "").encode())
            assert r.text_crc32 == (None if t is None else zlib.crc32(t.encode()))
    heavy = shards.assign_shards(df, [3.0] + [1.0] * 3).groupBy("shard").count().collect()
    share = {r[0]: r[1] / len(rows) for r in heavy}
    assert 0.45 < share[0] < 0.55
    assert shards.assign_shards(df.limit(0), weights).count() == 0


def fill(sizes, shares, budget, most):
    """Shares the budget and reshares what is above, until none is."""
    target, full = dict.fromkeys(sizes, 0.0), set()
    while True:
        left = budget - sum(most * sizes[s] for s in full)
        open_ = sum(shares[s] for s in sizes if s not in full)
        target = {s: most * sizes[s] if s in full else left * shares[s] / open_ for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def mix_rows():
    rows = [(i, "w " * (i % 13), ["b", "a", "c", "é", "Z"][i * i % 5]) for i in range(400)]
    return rows + [(900, None, None), (901, "x y z", None), (902, "", "a"), (903, "u " * 4000, "Z"), (1, "p q", "a")]


def test_mix_against_walk(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    shares = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = fill(sizes, shares, 1.5 * sum(sizes.values()), 2)
    source = {(i, size(t)): s for i, t, s in rows}
    taken = Counter()
    for r in found:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0)
        assert r.position is None or 0 <= r.position <= 1
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5
    # Within a source the first pass follows md5 and its positions rise.
    for s in sizes:
        mine = sorted((r for r in found if source[r.doc_id, r.size] == s and r.position is not None and r.size),
                      key=lambda r: (md5(str(r.doc_id).encode()).hexdigest(), r.doc_id, r.size))
        assert [r.position for r in mine] == sorted(r.position for r in mine)


def test_mix_curriculum_integral():
    for schedule in mixing.CURRICULUM:
        areas = schedule.areas()
        assert areas[-1] == pytest.approx(1.0)


def test_mixed_documents(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    words = {(r.doc_id, r.size): r.taken for r in mixing.mix(df).collect()}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    times = Counter((r.doc_id, len((r.text or "").split())) for r in out.collect())
    for (i, n), taken in words.items():
        assert times[i, n] == (int(taken / n + 0.5) if n else 0)
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("name", ["op1_warc", "op4_topk", "op7_exact_dedup", "op8_mixture"])
def test_query_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = queries.QUERIES[name](spark, sf_dir)
    columns = ", ".join(found.columns)
    wanted = con.execute(f"SELECT {columns} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))
