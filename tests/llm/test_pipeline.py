import re

import corpus_pipeline as pipeline
from ringwatch.llm import langid
from test_simhash import brute_components, brute_print


def test_each_stage_against_its_input(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [n for n, _ in pipeline.STAGES] == ["language", "exact_dedup", "simhash_dedup", "mixture", "pieces"]
    for name, stage in pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(out)
        seen[name] = (docs, spark.read.parquet(out))
        docs = spark.read.parquet(out)
        if name != "pieces":
            assert sorted(docs.columns) == sorted(columns)

    before, after = (x.collect() for x in seen["language"])
    found = {r.doc_id: r._language for r in langid.identify(seen["language"][0]).collect()}
    assert {r.doc_id for r in after} == {i for i, f in found.items() if f.lang != "und" and f.score >= 0.5}
    assert len(after) > 0.95 * len(before)

    before, after = (x.collect() for x in seen["exact_dedup"])
    first = {}
    for r in before:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())

    before, after = (x.collect() for x in seen["simhash_dedup"])
    label = brute_components([brute_print(r.text) for r in before], 4)
    least = {}
    for r, c in zip(before, label):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(least.values())

    before, after = (x.collect() for x in seen["mixture"])
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    assert abs(words(after) / words(before) - 1.5) < 0.1
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text == texts[r.doc_id] for r in after)

    last = docs.collect()
    assert len(last) == len(after) and all(r.decoded == texts[r.doc_id] for r in last)


def test_run(spark, sf_dir):
    assert pipeline.run(spark, sf_dir).count() > 0
