import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ringwatch.llm import simhash
from ringwatch.llm.components import components
from ringwatch.session import Scratch


def brute_print(text, k=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


def test_fingerprint():
    texts = [None, "", " \n", "One", "one two", "A b C d", "é ÀB c\x0bd  e\tf", "x " * 70000 + "y z", " lead and trail  "]
    for t in texts:
        assert simhash.fingerprint(t, 4) % (1 << 64) == brute_print(t)


def test_near_duplicates_brute(spark):
    r = random.Random(5)
    vocabulary = ["".join(r.choices("abcdef", k=4)) for _ in range(60)]
    rows = []
    for g in range(25):
        words = r.choices(vocabulary, k=r.choice([3, 30, 120]))
        for _ in range(r.randint(1, 8)):
            w = list(words)
            for _ in range(r.randint(0, 2)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            rows.append((len(rows), " ".join(w)))
    rows += [(500, None), (501, ""), (502, " "), (None, "lone text of five words"), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x")).repartition(3)
    found = simhash.near_duplicates(df, 4, 4, part=8).collect()
    assert len(found) == len(rows)
    prints = [brute_print(t) for _, t in rows]
    label = brute_components(prints, 4)
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    wanted = Counter((i, f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, prints, label))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == wanted
    assert sum(r.kept for r in found) == len(set(label))
    left = simhash.drop_near_duplicates(df)
    assert left.columns == df.columns and left.count() == len(set(label))
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("part", [4, 512])
def test_links_connect_exactly(spark, part):
    r = random.Random(9)
    prints = set()
    for _ in range(40):
        base = r.getrandbits(64)
        for _ in range(r.randint(1, 30)):
            p = base
            for _ in range(r.randint(0, 5)):
                p ^= 1 << r.randrange(64)
            prints.add(p)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    scratch = Scratch(spark)
    links = simhash.close_links(df, 4, scratch, part)
    labels = {r.node: r.label for r in components(links, scratch).collect()}
    label = brute_components(prints, 4)
    mine = [labels.get(p, p) for p in signed]
    pairs = set(zip(mine, label))
    assert len(pairs) == len(set(label)) == len(set(mine))


def test_components_of_chain_and_star(spark):
    r = random.Random(2)
    chain = list(range(300))
    r.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {x.node: x.label for x in components(df, Scratch(spark)).collect()}
    assert found == {**dict.fromkeys(range(300), 0), **dict.fromkeys(range(1000, 1400), 1000)}


def test_masks_cover():
    masks = simhash._masks(4)
    r = random.Random(1)
    for _ in range(300):
        diff = sum(1 << b for b in r.sample(range(64), 4))
        assert any(diff & (m % (1 << 64)) == 0 for m in masks)
    assert len(masks) == 15


def test_tasks_follow_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS_PER_TASK", 1000)
    links = simhash.close_links(spark.range(200).toDF("fp"), 4, Scratch(spark), part=10)
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    # Of 15 masks, 10 leave all 200 in one bucket, which is 20,000 pairs.
    assert int(re.search(r"Repartition (\d+), true", plan)[1]) >= 10 * 20_000 // 1000


def part_of(spark, prints):
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    tables = [table(F.col("fps")).alias(f"t{i}") for i, table in enumerate(simhash.distance_tables())]
    rows = spark.createDataFrame(signed, "fps long").select("fps", *tables).toPandas()
    return simhash.Part.of(rows)


@pytest.mark.parametrize("block", [3, 50, 512])
def test_close_pairs_by_tables_and_steps(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(11)
    bases = [r.getrandbits(64) for _ in range(12)]
    left, right = ([r.choice(bases) ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(n)] for n in (140, 90))
    a, b = part_of(spark, left), part_of(spark, right)
    references = simhash._references(simhash.REFERENCES).tolist()
    assert a.table.tolist() == [[(p ^ x).bit_count() for x in references] for p in a.prints.tolist()]
    assert sorted(a.prints.tolist()) == sorted(left) and (np.diff(a.table[:, 0]) >= 0).all()
    found = sorted((a.prints[i], b.prints[j]) for x, y in simhash._close_pairs(a, b, 4) for i, j in zip(x, y))
    assert found == sorted((p, q) for p in left for q in right if (p ^ q).bit_count() <= 4)
