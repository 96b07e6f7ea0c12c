"""Every registered query on tables with nulls, repeated rows and columns of all helper names, and on empty ones."""

import math
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ringwatch.llm import queries, shards

CLASHES = (
    "_key _more _row _id _text _Language _found _pieces _fresh _secret _length _head _open _bits _map_row _full _keep _source_key "
    "_order _block _at _by _before _wanted KEPT fp label node n rank phrase score lang_pred fit rule verdict x v ring pivot "
    "distance size shard slot taken target position token_ids decoded component_id fingerprint payload record_type part mass"
).split()

TEXT = "The quick brown fox, the quick brown fox jumps over the lazy dog at 10:30 and mails a.b@example.org again. "
DOCUMENTS = [
    (1, TEXT * 3, "en", "web"), (2, TEXT * 3, "en", "web"), (2, TEXT * 3, "en", "web"), (3, None, None, None), (4, "", "en", None),
    (None, TEXT, None, "web"), (5, "   \n\t ", "fr", "books"), (6, "Der schnelle braune Fuchs springt über den faulen Hund. " * 9, "de", "books"),
    (7, "x" * 100_000, "en", "web"), (8, "wort " * 30_000, "de", "é"), (9, "123 456", None, "web"), (100, TEXT * 3 + "end", "en", "web"),
]
PAGES = [
    (1, "http://a.net/fr/1", "<p>one two three</p>" * 20), (2, "http://b.org/", "<p>one two three</p>" * 20), (2, "http://b.org/", "<p>one two three</p>" * 20),
    (3, None, None), (None, "no url", ""), (4, "http://c.com/en/", "<div>" * 3000 + "deep"), (5, "http://d.org/" + "p" * 70_000, "<article><p>text here.</p></article>"),
]
EMBEDDINGS = [
    (0, [0.5, -0.25, 1.0], 1), (50, [0.5, -0.25, 1.0], None), (50, [0.1, 0.2, 0.3], 1), (1, None, 1), (2, [], 1), (3, [1.0, None, 2.0], 1),
    (4, [float("nan"), 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], 1), (100, [3.0, -1.0, 0.5], 1), (7, [0.5, -0.25, 1.0], 2), (8, [2.0, 2.0, -2.0], 2),
]
TABLES = {
    "documents": ("doc_id long, text string, lang string, source string", DOCUMENTS),
    "pages": ("page_id long, url string, html string", PAGES),
    "embeddings": ("vec_id long, embedding array<float>, label int", EMBEDDINGS),
}
#: Queries that answer every row of their table with a row.
ROWS = {
    "op1_warc": "pages", "op2_pieces": "documents", "op3_main_text": "pages", "op5_language": "documents", "op6_shards": "documents",
    "op7_exact_dedup": "documents", "op8_mixture": "documents", "op9_pseudonyms": "documents", "op10_simhash": "documents", "op11_url_filter": "pages",
}
ALL = {**queries.QUERIES, "pipeline": corpus_pipeline.run}


def folder(spark, path, full):
    for name, (schema, rows) in TABLES.items():
        df = spark.createDataFrame(rows if full else [], schema).coalesce(2)
        taken = {c.lower() for c in df.columns}
        df = df.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c.lower() not in taken])
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("odd"), True)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("empty"), False)


@pytest.mark.parametrize("name", ALL)
def test_odd_rows_and_clashing_names(spark, odd, name):
    rows = ALL[name](spark, odd).collect()
    if name in ROWS:
        assert len(rows) == len(TABLES[ROWS[name]][1])


@pytest.mark.parametrize("name", ALL)
def test_empty_tables(spark, empty, odd, name):
    found = ALL[name](spark, empty)
    assert found.count() == 0
    wanted = ALL[name](spark, odd)
    if name != "pipeline":
        assert found.dtypes == wanted.dtypes


def test_the_rendezvous_winner_by_brute_force(spark):
    weights = [1.0, 2.0, 0.5, 1.0, 3.0]

    def score(key, shard):
        first = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        bits = xxhash.xxh64_intdigest(struct.pack("<i", shard), first) >> 11
        return -weights[shard] / math.log((bits + 0.5) / (1 << 53))

    keys = [*range(-50, 400), 1 << 62, -(1 << 63)]
    rows = spark.createDataFrame([(k, "t") for k in keys], "doc_id long, text string")
    found = {r.doc_id: r.shard for r in shards.assign_shards(rows, weights).collect()}
    assert found == {k: max(range(5), key=lambda s: (score(k, s), -s)) for k in keys}
