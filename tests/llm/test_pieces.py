import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from ringwatch.llm import pieces, queries

MODEL = queries.PIECE_MODEL


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def scanned(model, text, chunk):
    normal = model.processor.normalize(text)
    side, chunks = model.longest, []
    for start in range(0, max(1, len(normal)), chunk):
        end, low = min(len(normal), start + chunk), max(0, start - side)
        chunks.append(pieces.Chunk(model, normal[low : end + side], start - low, end - low))
    path = pieces.states_between([c.matrix() for c in chunks], (0, 0), None)
    return [t for c, a, b in zip(chunks, path, path[1:]) for t in c.trace(a, b)]


def random_text(r):
    alphabets = ["abe \n", "aaab", list("日本語é🦩 xyз \t▁"), ["the", " ", "  ", "ing", "tion", "    ", "\n", "==", "://", "00"]]
    return "".join(r.choices(r.choice(alphabets), k=r.randint(1, 250)))


def test_scan_equals_library(library):
    r, model = random.Random(3), pieces.load(MODEL)
    for _ in range(200):
        text = random_text(r)
        tokens = scanned(model, text, r.choice([1, 5, 16, 33, 90]))
        assert [i for t in tokens for i in model.ids(t)] == library.encode(text)


def test_product_is_associative(library):
    r, model = random.Random(8), pieces.load(MODEL)
    normal = model.processor.normalize("".join(r.choices("the ing ab", k=200)))
    chunks = [pieces.Chunk(model, normal, a, a + 50) for a in range(0, 200, 50)]
    a, b, c, d = [x.matrix() for x in chunks]
    left = pieces.product(pieces.product(pieces.product(a, b), c), d)
    right = pieces.product(a, pieces.product(b, pieces.product(c, d)))
    assert left == right
    assert all(v == {k: 0.0 for k in v} for v in left.values())


def test_unigram_scan_is_the_best_path():
    """The pieces read as a unigram model, against a plain search over the whole text."""
    model, r = pieces.Pieces(MODEL, "unigram"), random.Random(6)
    for _ in range(40):
        text = random_text(r)[:120]
        normal = model.processor.normalize(text)
        best = [0.0] + [None] * len(normal)
        for end in range(1, len(normal) + 1):
            ways = []
            for n in range(1, min(model.longest, end) + 1):
                token = normal[end - n : end]
                if (n == 1 or token in model.id) and best[end - n] is not None:
                    ways.append(best[end - n] + model.score.get(token, model.unknown_score))
            best[end] = max(ways)
        tokens = scanned(model, text, r.choice([3, 17, 40]))
        assert "".join(tokens) == normal
        assert sum(model.score.get(t, model.unknown_score) for t in tokens) == pytest.approx(best[-1])


def test_encode_and_decode(spark, library):
    r = random.Random(5)
    texts = [None, "", " ", "  a  b\n\tc ", "word " * 900, "x" * 3000, "é日🦩" * 500] + [random_text(r) for _ in range(40)]
    rows = [(i % 30, t, "x", [1]) for i, t in enumerate(texts)] + [(None, "again " * 700, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string, token_ids array<int>").repartition(3)
    found = pieces.encode(df, MODEL, giant=400, chunk=128).withColumn("back", pieces.decode(F.col("token_ids"), MODEL))
    got = sorted((str(x.doc_id), str(x.text), str(x.token_ids), str(x.back)) for x in found.collect())
    want = []
    for i, t, *_ in rows:
        ids = None if t is None else library.encode(t)
        # The model's own mark for a space decodes to a space; all other texts come back as they are.
        assert t is None or "▁" in t or library.decode(ids) == t
        want.append((str(i), str(t), str(ids), str(None if t is None else library.decode(ids))))
    assert got == sorted(want)
    assert pieces.encode(df.limit(0), MODEL).count() == 0


def test_many_groups(spark, library, monkeypatch):
    monkeypatch.setattr(pieces, "GROUP", 3)
    text = "thing and other   words " * 300
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pieces.encode(df, MODEL, giant=100, chunk=64).first().token_ids == library.encode(text)


def test_query_round_trip(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op2_pieces(spark, sf_dir).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.decoded == docs[r.doc_id] and r.n_tokens == len(r.token_ids)
        assert r.token_ids == library.encode(docs[r.doc_id])
