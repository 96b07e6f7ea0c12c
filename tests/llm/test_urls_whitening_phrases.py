import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from ringwatch.llm import phrases, queries, urls, whitening

# URL filter

PAGES = "page_id long, url string, html string, node string, FIT string"
CANONICAL = '<head><link rel="canonical" href="{}"></head>'


def page(i, url, html=""):
    return (i, url, html, "x", "y")


def verdicts(spark, rows, **options):
    found = urls.judge(spark.createDataFrame(rows, PAGES), queries.URL_RULES, **options).collect()
    assert len(found) == len(rows)
    return {r.page_id: (r.rule, r.verdict) for r in found}


def test_rules_by_host_and_path(spark):
    rows = [
        page(1, "http://example.com/en/1"), page(2, "https://WWW.Example.COM/en/1"), page(3, "http://b.www.example.com/en/"),
        page(4, "http://example.com/EN/"), page(5, "http://notexample.com/en/x"), page(6, "http://x.net/es/?q"),
        page(7, "http://x.net/es"), page(8, "http://net/fr/"), page(9, "ftp://com"), page(10, "x.com/en/"), page(11, None),
        page(12, "http://x.org/en/"), page(13, "http://com.org/"), page(14, "http://m.example.com/en/a?b#c"), page(15, "://com/"),
    ]
    found = verdicts(spark, rows)
    assert found == {
        1: ("example.com/en/", "block"), 2: ("www.example.com/en/", "allow"), 3: ("www.example.com/en/", "allow"),
        4: ("com/", "allow"), 5: ("com/", "allow"), 6: ("net/es/", "block"), 7: (None, "allow"), 8: ("net/fr/", "block"),
        9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"), 12: (None, "allow"), 13: (None, "allow"),
        14: ("example.com/en/", "block"), 15: ("com/", "allow"),
    }


def test_blocks_reach_aliases_and_allows_come_first(spark):
    rows = [
        page(1, "http://a.org/x", CANONICAL.format("http://b.net/fr/x")),
        page(2, "http://c.org/y", "<HEAD><META content=\"0; URL='//d.net/es/z?q=1&amp;r=2'\" HTTP-EQUIV=refresh>"),
        page(3, "HTTP://C.ORG/y#part"), page(4, "http://e.net/en/", "<link href=/fr/e rel='x Canonical'>"),
        page(5, "http://e.net/en/deep/er", "<link rel=canonical href=../../es/./f>"),
        page(6, None, CANONICAL.format("http://b.net/fr/x")), page(7, "http://f.org/", "<!--" + CANONICAL.format("http://b.net/fr/")),
        page(8, "http://g.org/", "<body>" + CANONICAL.format("http://b.net/fr/")),
        page(9, "http://h.org/", CANONICAL.format("http://i.org/")), page(10, "http://i.org/", CANONICAL.format("http://j.net/fr/")),
        page(11, "http://j.com/", CANONICAL.format("http://h.org/")), page(12, "http://k.org/", CANONICAL.format("mailto:a@b.net")),
        page(13, "http://l.org/", None), page(14, "http://a.org/x"), page(15, "http://j.net/fr/"), page(16, "nowhere", CANONICAL.format("/fr/")),
        page(17, "http://m.org/a", "<script>'" + CANONICAL.format("http://b.net/fr/") + "'</script>" + CANONICAL.format("?b=1")),
    ]
    found = {i: v for i, (_, v) in verdicts(spark, rows).items()}
    blocked = {1, 2, 3, 4, 5, 14, 15}  # 9 and 10 share a component with 11, which a rule allows
    assert {i for i, v in found.items() if v == "block"} == blocked


def test_redirect_table_and_long_chains(spark):
    n = 300
    rows = [page(i, f"http://s{i}.org/p") for i in range(n)]
    hops = [(f"http://s{i}.org/p", f"http://s{i + 1}.org/p") for i in range(n - 1)] + [(f"http://s{n - 1}.org/p", "http://z.net/es/")]
    redirects = spark.createDataFrame(hops + [(None, "http://z.net/es/"), ("http://s0.org/p", None)], "from_url string, to_url string")
    assert {v for _, v in verdicts(spark, rows, redirects=redirects).values()} == {"block"}


def test_rule_tables_and_ties(spark):
    table = spark.createDataFrame(
        [("block", "a.b", "/x"), ("allow", "a.b", "/x"), ("block", "b", "/x/yz"), (None, None, "/"), ("block", "c", "/"), ("block", "c", "/")],
        "verdict string, host string, path string",
    )
    pages = spark.createDataFrame([page(1, "http://a.b/x/yz"), page(2, "http://q.a.b/x"), page(3, "http://c/"), page(3, "http://c/")], PAGES)
    found = sorted((r.page_id, r.rule, r.verdict) for r in urls.judge(pages, table).collect())
    assert found == [(1, "b/x/yz", "block"), (2, "a.b/x", "allow"), (3, "c/", "block"), (3, "c/", "block")]
    assert {r.verdict for r in urls.judge(pages, []).collect()} == {"allow"}
    assert urls.judge(pages.limit(0), table).count() == 0


def test_long_urls_and_pages(spark):
    long = "http://x.net/fr/" + "a" * 200_000
    rows = [page(1, long, "x" * 500_000 + "canonical"), page(2, "http://y.org/", CANONICAL.format(long)), page(3, "http://" + "a." * 5000 + "net/es/")]
    assert {i: v for i, (_, v) in verdicts(spark, rows).items()} == {1: "block", 2: "block", 3: "block"}


def test_url_statement_on_links(spark, tmp_path):
    rows = [
        (1, "http://a.org/x", CANONICAL.format("http://b.net/fr/x")), (2, "http://c.org/y", CANONICAL.format("/x?a&amp;b")),
        (3, "http://c.org/x?a&b", '<meta http-equiv="refresh" content="3;url=http://a.org/x">'), (4, None, None),
        (5, "http://d.org/e/f", CANONICAL.format("g")), (6, "http://d.org/e/g", CANONICAL.format("https://h.net/es/")), (7, "http://h.com", ""),
    ]
    folder = str(tmp_path)
    pd.DataFrame(rows, columns=["page_id", "url", "html"]).to_parquet(f"{folder}/pages.parquet")
    found = sorted(tuple(r) for r in queries.op11_url_filter(spark, folder).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    assert found == sorted(con.execute(queries.SQL["op11_url_filter"]).fetchall())
    assert [r[0] for r in found if r[-1] == "block"] == [1, 2, 3, 5, 6]


def test_url_filter_stays_in_the_jvm(spark, sf_dir):
    plan = queries.op11_url_filter(spark, sf_dir)._jdf.queryExecution().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert bad not in plan


# Whitening


def expected(rows, most=16):
    """vec_id -> (deviation, whitened up to sign) by plain formulas, with n and the explained shares."""
    used = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in used}), dtype=object)
    n, total = len(fit), fit.sum(0)
    centred = (fit * n - total).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = []
    for i, x in used:
        off = [n * a - int(s) for a, s in zip(x, total)]
        w = (np.array(off, dtype=float) / n) @ vectors[:, :most] / np.sqrt(values[:most])
        found.append((i, sum(o * o for o in off), w))
    return found, n, values[:most] / values.sum()


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


def test_whitening_against_formulas(spark, sf_dir):
    table = pd.read_parquet(f"{sf_dir}/embeddings.parquet")
    wanted, n, shares = expected([(i, v) for i, v in zip(table.vec_id, table.embedding) if usable(v)])
    found = defaultdict(dict)
    for r in queries.op12_whitening(spark, sf_dir).collect():
        found[r.vec_id][r.component] = r
        assert r.n == n and r.identity_error < 1e-9
    assert sorted(found) == sorted(i for i, _, _ in wanted)
    for i, deviation, w in wanted:
        rows = [found[i][c] for c in range(1, 17)]
        assert {r.deviation for r in rows} == {deviation}
        assert np.allclose(np.abs([r.whitened for r in rows]), np.abs(w), atol=1e-8)
        assert np.allclose([r.explained for r in rows], shares, rtol=1e-9)


def test_whitening_signs_are_shared(spark, sf_dir):
    rows = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).toPandas()
    wide = rows.drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened")
    assert np.allclose(np.cov(wide.to_numpy().T, bias=True), np.eye(16), atol=0.05)


VECTORS = "vec_id long, embedding array<double>, x string, V string"


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=3) * (1, 1000, 1e-1)], "a", "b") for i in range(60)]
    rows += [(7, rows[0][1], "a", "b")] * 40  # repeated id and vector: a row each, fitted once
    good = list(rows)
    rows += [(100, None, "", ""), (101, [], "", ""), (102, [1.0, None, 2.0], "", ""), (103, [1.0, float("nan"), 2.0], "", ""),
             (104, [1.0, float("-inf"), 2.0], "", ""), (105, [1.0, 2.0], "", ""), (106, [1e300, 0.0, 0.0], "", ""), (None, rows[1][1], "", "")]
    wanted, n, shares = expected([(i, v) for i, v, *_ in good] + [(None, rows[1][1])], 3)
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(7)).collect()
    assert len(found) == 3 * len(wanted) and {r.n for r in found} == {n} == {60}
    assert Counter((r.vec_id, int(r.deviation)) for r in found if r.component == 1) == Counter((i, d) for i, d, _ in wanted)
    got = sorted((str(r.vec_id), r.component, abs(r.whitened)) for r in found)
    plain = sorted((str(i), c + 1, abs(w[c])) for i, _, w in wanted for c in range(3))
    assert [g[:2] for g in got] == [p[:2] for p in plain]
    assert np.allclose([g[2] for g in got], [p[2] for p in plain], atol=1e-8)
    assert np.allclose(sorted({r.explained for r in found}, reverse=True), shares, rtol=1e-6)


def test_whitening_huge_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in rng.integers(-(1 << 54), 1 << 54, 4)], "", "") for i in range(20)]
    wanted, n, shares = expected([(i, v) for i, v, *_ in rows], 4)
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    exact = {i: d for i, d, _ in wanted}
    assert all(r.deviation is None if exact[r.vec_id] >= 10**38 else r.deviation == exact[r.vec_id] for r in found)
    assert np.allclose(sorted({r.explained for r in found}, reverse=True), shares, rtol=1e-6)
    assert max(r.identity_error for r in found) < 1e-4


def test_whitening_few_directions(spark):
    def size(rows):
        return whitening.whiten(spark.createDataFrame(rows, VECTORS)).count()

    assert size([]) == 0 and size([(1, None, "", "")]) == 0 and size([(1, [1.0, 2.0], "", "")] * 5) == 0
    line = [(i, [float(i), 2.0 * i, 3.0], "", "") for i in range(9)]
    found = whitening.whiten(spark.createDataFrame(line, VECTORS)).collect()
    assert len(found) == 9 and {r.component for r in found} == {1} and all(abs(r.explained - 1) < 1e-12 for r in found)


# Collocations


def brute(rows, min_count=10, longest=3, top=2000, covered=50):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        around = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inner = p[i : i + size]
                    around[inner] = max(around[inner], a)
        scored = []
        for p, a in candidates.items():
            score, _, left, right = min(
                (1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            if 100 * around[p] < covered * a or not around[p]:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


DOCUMENTS = "doc_id long, text string, lang string, n long, Phrase string"


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, t, lang, 0, "") for i, (t, lang) in enumerate(rows)], DOCUMENTS)
    return sorted(tuple(r) for r in phrases.collocations(df.repartition(5), **options).collect())


def test_collocations_against_brute_force(spark, sf_dir):
    table = pd.read_parquet(f"{sf_dir}/documents.parquet")
    rows = list(zip(table.text, table.lang))
    rows += [(None, "en"), ("", None), ("A b\tC  d. " * 12, None), ("a b c d." * 9 + "É é\x0bx\x00y z! " * 30, "und"), ("  \n..", "zz")]
    rows += [(rows[0][0], rows[0][1])] * 15
    assert mined(spark, rows) == brute(rows)


def test_collocations_other_settings(spark):
    rng = np.random.default_rng(3)
    words = ["a", "bb", "A", "c.", "d,e", "ff", "é", "\t", "g"]
    rows = [(" ".join(words[i] for i in rng.integers(0, 9, 400)), lang) for lang in ("x", "y", None) for _ in range(6)]
    for options in ({"min_count": 3, "longest": 4, "top": 50}, {"min_count": 1, "longest": 2}, {"longest": 5, "covered": 20, "top": 7}):
        assert mined(spark, rows, **options) == brute(rows, **options)


def test_collocations_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, None), ("a b", "x")]) == []


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(4)
    text = "".join(rng.choice(["ab", "cde", " ", "  ", "\t", ".", "x" * 30, "\n"], 4000))
    whole = list(phrases._grams(iter([text.encode()]), b"", phrases._Hasher(2), 3))
    counted = Counter(k for _, found in whole for n, (keys, more), _, _ in found for k in zip([n] * len(keys), keys, more))
    for chunk in (1, 7, 64, 1000):
        monkeypatch.setattr(phrases, "CHUNK", chunk)
        parts = phrases._grams(iter([text.encode()]), b"", phrases._Hasher(2), 3)
        again = Counter(k for _, found in parts for n, (keys, more), _, _ in found for k in zip([n] * len(keys), keys, more))
        assert again == counted


@pytest.mark.parametrize("seed", range(5))
def test_misra_gries_loses_nothing_frequent(monkeypatch, seed):
    monkeypatch.setattr(phrases, "HELD", 50)
    rng, threshold = np.random.default_rng(seed), 10
    keys = np.concatenate([rng.integers(0, 5000, 3000), np.repeat(rng.integers(0, 5000, 200), 10), np.full(2000, 77)]).astype(np.uint64)
    rng.shuffle(keys)
    summary = phrases.MisraGries(len(keys) // threshold + 1)
    for part in np.array_split(keys, 40):
        summary.add(*phrases._summed(part, np.ones(len(part), np.int64)))
        assert len(summary.keys) <= summary.capacity
    counts = Counter(keys.tolist())
    kept = set(summary.at_least(threshold).tolist())
    assert {k for k, c in counts.items() if c >= threshold} <= kept
    assert summary.taken_off < threshold
    assert all(counts[int(k)] - c <= summary.taken_off for k, c in zip(summary.keys, summary.counts))


def test_collocations_of_many_partitions_and_flushes(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(phrases, "PARTITION_BYTES", 1 << 14)
    table = pd.read_parquet(f"{sf_dir}/documents.parquet")
    rows = list(zip(table.text, table.lang))[:60]
    assert mined(spark, rows, min_count=4) == brute(rows, min_count=4)
