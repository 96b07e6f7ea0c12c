"""The queries of the operators and, where SQL can express them, their statements."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm import (
    exact, htmltext, langid, mixing, phrases, pieces, pii, shards, simhash, topk, urls, warc, whitening,
)
from ringwatch.llm.common import single_spaced, table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
#: Of the query only; a user gives a key of their own.
PSEUDONYM_KEY = "key of the test tables"
#: A public SentencePiece model, at the same path on every executor.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"))


def tokenised(docs: DataFrame, model_file: str = PIECE_MODEL) -> DataFrame:
    """Ids of every whole text, their number, and the text they decode to."""
    found = pieces.encode(docs, model_file, back=True)
    n_tokens = F.coalesce(F.size("token_ids"), F.lit(0)).cast("bigint")
    return found.select("doc_id", n_tokens.alias("n_tokens"), "token_ids", "decoded")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract_pages(pages).select("page_id", "url", "text", "n_chars")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found, name = langid.identify(docs), langid.language_column(docs)
    return found.select(
        "doc_id", langid.is_held_out().alias("held_out"),
        F.col(f"{name}.lang").alias("lang_pred"), F.col(f"{name}.score").alias("score"),
    )


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    placed = shards.assign_shards(docs, [1.0] * SHARDS, grown=[1.0] * (SHARDS + 1))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(single_spaced(F.col("text")), 256)
    return exact.exact_duplicates(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.in_training_order(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PSEUDONYM_KEY)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


#: The rules of the query.
URL_RULES = [
    urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"),
]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_warc, op2_pieces, op3_main_text, op4_topk, op5_language, op6_shards, op7_exact_dedup, op8_mixture,
        op9_pseudonyms, op10_simhash, op11_url_filter, op12_whitening, op13_collocations,
    )
}

_SPACES = r"[\x20\x09-\x0D]+"

SQL = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f
    """,
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id) q JOIN v c ON c.vec_id <> q.vec_id
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op7_exact_dedup": rf"""
        WITH n AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g')) AS h
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
        FROM n WINDOW w AS (PARTITION BY h)
    """,
    "op8_mixture": r"""
        WITH d AS (
            SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS o,
                   CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS turn
            FROM d GROUP BY source
        ), w AS (
            SELECT *, CASE turn WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS share,
                   2.0::DOUBLE * source_size AS most
            FROM s
        ), l AS (
            SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()
                   - coalesce(sum(most) OVER (ORDER BY most / share ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                   AS left_over,
                   sum(share) OVER (ORDER BY most / share ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
            FROM w
        ), v AS (
            SELECT min_by(left_over / open, most / share) AS level FROM l WHERE most / share > left_over / open
        ), t AS (
            SELECT l.source, turn, source_size,
                   CASE WHEN level IS NULL OR most <= level * share THEN most ELSE level * share END AS target
            FROM l, v
        ), b AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, t.turn,
                   CAST(floor(t.target + 0.5) AS BIGINT) AS wanted,
                   CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        ), p AS (
            SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS passes FROM b
        )
        , k AS (
            SELECT doc_id, size, source_size, target, turn,
                   CAST(passes * size + greatest(least(wanted - passes * source_size - prior, size), 0) AS BIGINT) AS taken,
                   prior / nullif(wanted, 0) AS used
            FROM p
        )
        -- The time by which a source's falling, level or rising weight has spent the words before.
        SELECT doc_id, size, source_size, target, taken,
               CASE WHEN taken > 0 THEN least(CASE
                   WHEN turn = 0 THEN 2 * used / (1.5::DOUBLE + sqrt(greatest(2.25::DOUBLE - 2 * used, 0)))
                   WHEN turn = 1 THEN used
                   WHEN used < 0.375::DOUBLE THEN 2 * used / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2 * used))
                   ELSE 0.5::DOUBLE + 2 * (used - 0.375::DOUBLE) / (1 + sqrt(1 + 2 * (used - 0.375::DOUBLE))) END, 1.0::DOUBLE) END AS position
        FROM k
    """,
    # Segments . and .. in the path of a relative link are left to the tests.
    "op11_url_filter": r"""
        WITH RECURSIVE p AS (
            SELECT page_id, url, html, coalesce(instr(url, '://'), 0) AS cut FROM pages
        ), u AS (
            SELECT page_id, url, html,
                   CASE WHEN cut > 0 THEN translate(regexp_extract(substr(url, cut + 3), '^[^/?#]*'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
                   CASE WHEN cut > 0 THEN regexp_extract(substr(url, cut + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
            FROM p
        ), rules(verdict, host, path) AS (
            VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                   ('block', 'net', '/es/'), ('block', 'net', '/fr/')
        ), h AS (
            SELECT url, regexp_extract(regexp_replace(html,
                '(?is)<!--.*?(-->|\z)|<script\b.*?(</script\s*>|\z)|<style\b.*?(</style\s*>|\z)', ' ', 'g'),
                '(?is)^(.*?)(</head\b|<body\b|\z)', 1) AS head
            FROM p WHERE regexp_matches(html, '(?i)canonical|refresh')
        ), tags AS (
            SELECT url, unnest(regexp_extract_all(head, '(?i)<(?:link|meta)\b[^>]*>')) AS tag FROM h
        ), attributes AS (
            SELECT url, lower(regexp_extract(tag, '(?i)^<([a-z]+)', 1)) AS kind,
                   lower(trim(regexp_extract(tag, '(?i)\s(?:rel|http-equiv)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '"''')) AS role,
                   trim(regexp_extract(tag, '(?i)\s(?:href|content)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '"') AS said
            FROM tags
        ), targets AS (
            SELECT url, CASE WHEN kind = 'link' THEN trim(said, ' ''')
                   ELSE trim(regexp_extract(said, '(?i)^[\d.\s]*[;,]?\s*url\s*=\s*["'']?([^"'']*)', 1)) END AS target
            FROM attributes
            WHERE kind = 'link' AND list_contains(string_split(role, ' '), 'canonical') OR kind = 'meta' AND role = 'refresh'
        ), links AS (
            SELECT url AS from_url, CASE
                WHEN regexp_matches(target, '^(?i)https?://') THEN target
                WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') OR NOT contains(url, '://') THEN NULL
                WHEN target[1:2] = '//' THEN regexp_extract(url, '^.*?:') || target
                WHEN target[1] = '/' THEN regexp_extract(url, '^.*?://[^/?#]*') || target
                WHEN target[1] = '?' THEN regexp_extract(url, '^[^?#]*') || target
                WHEN target[1] = '#' THEN url
                ELSE regexp_extract(url, '^.*?://[^/?#]*')
                     || coalesce(nullif(regexp_extract(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '^.*/'), ''), '/')
                     || target END AS to_url
            FROM (SELECT url, replace(target, '&amp;', '&') AS target FROM targets) WHERE target <> ''
        ), ends AS (
            SELECT from_url AS url FROM links UNION SELECT to_url FROM links UNION SELECT url FROM u
        ), spelled AS (
            SELECT url, regexp_extract(url, '^[^#]*') AS whole FROM ends WHERE contains(url, '://')
        ), nodes AS (
            SELECT url, lower(regexp_extract(whole, '^.*?://[^/?]*'))
                   || substr(whole, 1 + length(regexp_extract(whole, '^.*?://[^/?]*'))) AS node
            FROM spelled
        ), edges AS (
            SELECT a.node AS a, b.node AS b FROM links l JOIN nodes a ON a.url = l.from_url JOIN nodes b ON b.url = l.to_url
            UNION SELECT b.node, a.node FROM links l JOIN nodes a ON a.url = l.from_url JOIN nodes b ON b.url = l.to_url
        ), reach AS (
            SELECT a AS node, a AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other
        ), named AS (
            SELECT DISTINCT node, regexp_extract(node, '://([^/?]*)', 1) AS host, regexp_extract(node, '://[^/?]*([^?]*)', 1) AS path
            FROM reach
        ), fits AS (
            SELECT n.node, r.verdict, row_number() OVER (
                       PARTITION BY n.node ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC, r.verdict) AS place
            FROM named n JOIN rules r ON ends_with('.' || n.host, '.' || r.host) AND starts_with(n.path, r.path)
        ), blocked AS (
            SELECT r.node FROM reach r JOIN fits f ON f.node = r.other AND f.place = 1
            GROUP BY r.node HAVING bool_or(f.verdict = 'block') AND NOT bool_or(f.verdict = 'allow')
        ), b AS (
            SELECT u.page_id, u.url, u.host, u.path, r.host || r.path AS rule, r.verdict
            FROM u LEFT JOIN rules r ON ends_with('.' || u.host, '.' || r.host) AND starts_with(u.path, r.path)
        ), c AS (
            SELECT page_id, url, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
            FROM b GROUP BY page_id, url, host, path
        )
        SELECT c.page_id, c.host, c.path, c.rule, coalesce(c.verdict, CASE WHEN k.node IS NOT NULL THEN 'block' END, 'allow') AS verdict
        FROM c LEFT JOIN nodes n ON n.url = c.url LEFT JOIN blocked k ON k.node = n.node
    """,
    "op13_collocations": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang,
                   regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
            FROM documents
        ), p AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)
        ), g AS (
            SELECT lang, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS phrase
            FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM p, (SELECT unnest([1, 2, 3]) AS size))
        ), f AS (
            SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY ALL
        ), t AS (
            SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
        ), c AS (
            SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 10
        ), k AS (
            SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
            FROM (SELECT *, unnest(range(1, size)) AS k FROM c)
        ), s AS (
            SELECT k.lang, k.phrase, k.a, k.k, x.a AS l, y.a AS r,
                   CAST(1000000::HUGEINT * k.a * k.a // (x.a::HUGEINT * y.a) AS BIGINT) AS score
            FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.first JOIN f y ON y.lang = k.lang AND y.phrase = k.rest
        ), b AS (
            SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), o AS (
            SELECT lang, phrase, max(a) AS around
            FROM (SELECT lang, a, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS phrase FROM c WHERE size = 3)
            GROUP BY ALL
        ), q AS (
            SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
            FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
            WHERE o.around IS NULL OR 100 * o.around < 50 * b.a
        )
        SELECT q.lang, q.rank, q.phrase, q.a, q.l, q.r, t.n, q.score FROM q JOIN t USING (lang) WHERE q.rank <= 2000
    """,
}
