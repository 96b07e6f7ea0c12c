import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ringwatch.session import Scratch
from ringwatch.sources import csvfiles, ranges, tweets


def rows_of(data: bytes) -> list[list[str]]:
    """What the standard reader makes of a whole file, header and blank lines left out."""
    text = data.removeprefix(csvfiles.MARK).decode("utf-8", "ignore")
    found = [r for r in csv.reader(io.StringIO(text, newline="")) if any(c.strip() for c in r) or len(r) > 1]
    return found[1:]


def random_file(seed: int, size: int = 60) -> bytes:
    draw = random.Random(seed)
    cells = ["a", "", "b c", '"q\nr"', '"x""y"', '"\r\n,"', '""', 'in"side', '"closed"after', 'é"', '"a,b\n\n""\n"', "€", '"""\n"""', ' "n']
    lines = ["one,two,three"]
    for _ in range(size):
        lines.append(",".join(draw.choice(cells) for _ in range(3)) if draw.random() < 0.95 else "")
    return draw.choice(["\n", "\r\n"]).join(lines).encode() + (b"\n" if seed % 2 else b"")


def read_in_ranges(path: str, range_bytes: int) -> list[list[str]]:
    """The records of a file by its ranges one after another, without Spark."""
    with open(path, "rb") as file:
        length = len(file.read())
        body, _ = csvfiles._header(file, length)
        found, inside = [], False
        for start in range(body, length, range_bytes):
            low, high = ranges.segment(file, body, start, start + range_bytes, length)
            data = ranges.read_between(file, low, high)
            if not data:
                continue
            found += [r for _, r in csvfiles._records(file, low, data, inside) if r.strip()]
            inside = csvfiles.quoted_spans(data, inside)[1]
    return [next(csv.reader(io.StringIO(r, newline=""))) for r in found]


@pytest.mark.parametrize("seed", range(30))
def test_any_ranges_give_the_whole_read(tmp_path, seed):
    data = random_file(seed)
    (tmp_path / "f.csv").write_bytes(data)
    wanted = rows_of(data)
    for range_bytes in (1, 2, 3, 7, 16, 50, 333, 10_000):
        assert read_in_ranges(str(tmp_path / "f.csv"), range_bytes) == wanted, range_bytes


def test_states_are_composed(spark):
    draw = random.Random(8)
    rows = [(f"f{f}", p, draw.random() < 0.5, draw.random() < 0.5) for f in range(6) for p in range(40)]
    found = {(r.path, r.part): r.inside for r in csvfiles.entry_states(
        spark.createDataFrame(rows, "path string, part long, from_outside boolean, from_inside boolean")).collect()}
    for name in {r[0] for r in rows}:
        state = False
        for _, part, outside, inside in sorted(r for r in rows if r[0] == name):
            assert found[name, part] == state
            state = inside if state else outside


@pytest.mark.parametrize("range_bytes", [5, 64, 1 << 20])
def test_spark_reads_every_record_once(spark, tmp_path, range_bytes):
    wanted = []
    for seed in range(6):
        data = random_file(seed, 25)
        (tmp_path / f"f{seed}.csv").write_bytes((csvfiles.MARK if seed == 3 else b"") + data)
        wanted += [(f"f{seed}.csv", *(c if c not in csvfiles.MISSING else None for c in r)) for r in rows_of(data)]
    [df] = csvfiles.read_csv_files(spark, csvfiles.list_files(spark, str(tmp_path)), str.upper, range_bytes=range_bytes)
    assert df.columns == ["ONE", "TWO", "THREE", "_file", "_path", "_offset"]
    found = df.orderBy("_file", "_offset").collect()
    # What follows a closing quote is text to the standard reader and an odd cell to Spark's parser.
    plain = [(r._file, r.ONE, r.TWO, r.THREE) for r in found]
    assert len(plain) == len(wanted)
    assert all(f[0] == w[0] for f, w in zip(plain, wanted))
    odd = ("closedafter", 'é"', 'in"side', ' "n')
    for f, w in zip(plain, wanted):
        assert [None if a in odd else a for a in w[1:]] == [None if b in odd else a for a, b in zip(f[1:], w[1:])]
    assert df.select("_file", "_offset").distinct().count() == len(found)


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    text = 'user,text,date\n' + "".join(f'u{i},"line one @b{i}\nline, two ""{i}""\n",d{i}\n' for i in range(20_000))
    (tmp_path / "t.csv").write_text(text)
    posts = tweets.read_tweets(spark, csvfiles.list_files(spark, str(tmp_path)), range_bytes=50_000)
    tasks = posts.select(F.spark_partition_id().alias("t"), "user").groupBy("t").count().collect()
    assert sum(r["count"] for r in tasks) == 20_000 and len(tasks) >= 8
    row = posts.filter("user = 'u777'").first()
    assert row.text == 'line one @b777\nline, two "777"\n' and row.date == "d777"


def test_a_quote_that_is_never_closed(spark, tmp_path, monkeypatch):
    (tmp_path / "t.csv").write_text('user,text\na,b\nc,"open\nd,e\nf,g\n')
    found = tweets.read_tweets(spark, csvfiles.list_files(spark, str(tmp_path)), range_bytes=4).collect()
    assert [r.user for r in found][:1] == ["a"] and len(found) == 2
    monkeypatch.setattr(csvfiles, "MOST_RECORD_BYTES", 8)
    with open(tmp_path / "t.csv", "rb") as file, pytest.raises(ValueError, match="quote"):
        csvfiles._finished(file, b'c,"open\n', 23)


class Counting(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        data = super().read(size)
        self.taken += len(data)
        return data


def test_headers_read_little(tmp_path):
    body = b"x,y\n" * 500_000
    file = Counting(b"\n \none,two\n" + body)
    assert csvfiles._header(file, len(file.getvalue())) == (11, "one,two") and file.taken <= 64 << 10
    long = b'"' + b"h\n" * 50_000 + b'",two\n'
    file = Counting(long + body)
    at, line = csvfiles._header(file, len(file.getvalue()))
    assert at == len(long) and line.endswith('",two') and file.taken <= (64 << 10) + 2 * len(long)
    assert csvfiles._header(Counting(b"\n\n"), 2) == (2, "")


def test_ten_thousand_files_with_three_headers(spark, tmp_path):
    for i in range(10_000):
        (tmp_path / f"f{i:05d}.csv").write_text(("a,b\n", "b,a\n", "c\n")[i % 3] + f"{i},1\n" * (i % 2))
    files = csvfiles.list_files(spark, str(tmp_path))
    frames = csvfiles.read_csv_files(spark, files, str, scratch=Scratch(spark))
    assert sorted(tuple(f.columns[:-3]) for f in frames) == [("a", "b"), ("b", "a"), ("c",)]
    assert sum(f.count() for f in frames) == 5_000
