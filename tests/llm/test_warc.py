import os
import gzip
import hashlib
import io
import random

import pytest

from ringwatch.llm import queries, warc

SCHEMA = "page_id long, url string, html string, payload string, _row string"


def payload(i):
    r = random.Random(i)
    return "".join(r.choices("<>abc déf\n", k=r.choice([0, 5, 99, 100, 101, 3000, 40_000])))


def rows():
    made = [(i, f"http://h/{i}\r\nX: y", payload(i % 40), "p", "r") for i in range(200)]
    return made + [(300, None, None, None, None), (301, "u", "", "p", "r"), (None, "u", "z" * 500, "p", "r"),
                   (302, "u", "z" * 500, "p", "r"), (302, "u", "z" * 500, "p", "r"), (303, "u", "WARC/1.1\r\n" * 40, "p", "r")]


def wanted(pages):
    groups = {}
    for page, _, html, *_ in pages:
        groups.setdefault((html or "").encode(), []).append(page)
    found = []
    for body, ids in groups.items():
        digest, first = hashlib.sha256(body).hexdigest(), min((i for i in ids if i is not None), default=None)
        left = list(ids)
        if len(body) >= 100:
            left.remove(first)
            found.append((first, len(body), digest, "response", None))
            found += [(i, len(body), digest, "revisit", first) for i in left]
        else:
            found += [(i, len(body), digest, "response", None) for i in ids]
    return sorted(found, key=str)


@pytest.mark.parametrize("split", [1000, 1 << 20])
def test_round_trip(spark, monkeypatch, split):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    scratch = warc.Scratch(spark)
    folder = f"{scratch.folder}/a"
    warc.write_archives(warc.plan_records(df, scratch=scratch), folder)
    found = warc.read_archives(spark, folder, split).collect()
    mine = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(mine, key=str) == wanted(rows())
    bodies = {r.payload_digest: bytes(r.payload) for r in found if r.record_type == "response"}
    assert all(hashlib.sha256(b).hexdigest() == d for d, b in bodies.items())
    assert warc.round_trip(df.limit(0)).count() == 0


def member(fields, body):
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n", mtime=0)


def test_false_magic_and_every_split():
    """Stored blocks put raw magic bytes, and even a whole gzip member, inside a record."""
    r = random.Random(4)
    inner = gzip.compress(b"not a record") + warc.MAGIC * 5 + r.randbytes(300)
    data, starts = b"", []
    for i in range(12):
        body = inner * r.randint(1, 3) + r.randbytes(r.randint(0, 400))
        starts.append(len(data))
        head = f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {len(body)}\r\nX-Page-ID: {i}\r\n\r\n".encode()
        data += gzip.compress(head + body + b"\r\n\r\n", compresslevel=0, mtime=0)
        if i % 4 == 0:
            data += gzip.compress(b"padding that is no record")
    for size in (1, 7, 100, 333, len(data)):
        if size == 1:
            ranges = [(s, s + 1) for s in range(0, len(data), 97)] + [(s, s + 1) for s in starts]
            found = [(at, f["x-page-id"]) for a, b in sorted(set(ranges)) for at, f, _ in warc.scan_range(io.BytesIO(data), a, b)]
        else:
            found = [(at, f["x-page-id"]) for a in range(0, len(data), size)
                     for at, f, _ in warc.scan_range(io.BytesIO(data), a, min(a + size, len(data)))]
        assert found == [(s, str(i)) for i, s in enumerate(starts)]


def test_a_torn_archive_is_an_error():
    data = member({"WARC-Type": "response", "Content-Length": "3000"}, random.Random(1).randbytes(3000))
    with pytest.raises(EOFError):
        list(warc.scan_range(io.BytesIO(data[:-400]), 0, len(data)))
    assert list(warc.scan_range(io.BytesIO(b""), 0, 0)) == []


def test_query(spark, sf_dir):
    assert queries.op1_warc(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()


@pytest.mark.parametrize("level", [0, 6])
def test_a_header_of_any_length(level):
    data, starts = b"", []
    for n in (10, 65_300, 65_536, 400_000, 3_000_000):
        url = "".join(random.Random(n).choices("abcdefghij", k=n))
        head = f"WARC/1.1\r\nWARC-Target-URI: {url}\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\n".encode()
        starts.append((len(data), n))
        data += gzip.compress(head + b"body\r\n\r\n", compresslevel=level, mtime=0)
    found = [(at, len(f["warc-target-uri"])) for a in range(0, len(data), 50_000)
             for at, f, body in warc.scan_range(io.BytesIO(data), a, min(a + 50_000, len(data))) if body == b"body"]
    assert found == starts
    with pytest.raises(EOFError):
        list(warc.scan_range(io.BytesIO(data[: starts[-1][0] + 300_000]), 0, len(data)))
    assert list(warc.scan_range(io.BytesIO(gzip.compress(b"WARC/1.1\r\n" * 90_000)), 0, 10_000)) == []


def test_a_very_long_url_comes_back(spark):
    df = spark.createDataFrame([(1, "http://h/" + "x%7" * 200_000, "p" * 200), (2, "u", "q")], "page_id long, url string, html string")
    assert sorted(r.page_id for r in warc.round_trip(df).collect()) == [1, 2]


def test_ranges_are_read_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = [(i, f"http://x/{i}", os.urandom(2000).hex()) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.plan_records(pages), str(tmp_path))
    records = warc.read_archives(spark, str(tmp_path), split_bytes=8 << 10)
    tasks = records.groupBy(F.spark_partition_id()).count().collect()
    assert sum(t["count"] for t in tasks) == 300 and len(tasks) >= 16
