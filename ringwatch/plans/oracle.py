"""DuckDB statements with the same results as the registered queries.

They are computed from the given tables by the rules of the operators, with plain
joins, lists and recursion, and share no code with the queries.
"""

# Building blocks: common table expressions, in the order they depend on one another.

_EVENTS = """
ev AS (
    SELECT event_id, ts, CAST(ts AS DATE) AS day, CAST(date_trunc('week', ts) AS DATE) AS week,
           event_type AS kind,
           event_type IN ('click', 'view', 'error') AS social,
           event_type IN ('purchase', 'signup') AS price,
           'u' || user_id AS src, 'u' || regexp_extract(props, '"k": *([0-9]+)', 1) AS dst,
           user_id % 5 = 0 AS bot, event_type = 'error' AND value > 200 AS truth,
           'T' || (user_id % 15) AS symbol, value > 250 AS pump
    FROM events
)"""


def _edges(key: str) -> str:
    return f"""
ed AS (SELECT {key} AS b, event_id AS seq, src, dst FROM ev
       WHERE social AND length(src) > 0 AND length(dst) > 0)"""


_DEGREES = """
dg AS (
    SELECT b, node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree
    FROM (SELECT b, src AS node, 1 AS o, 0 AS i FROM ed UNION ALL SELECT b, dst, 0, 1 FROM ed)
    GROUP BY b, node
)"""


def _stars(degree: int) -> str:
    return f"""
stars AS (
    SELECT b, node AS hub_node, out_degree, round(out_degree / (out_degree + in_degree), 3) AS out_ratio
    FROM dg WHERE out_degree >= {degree} AND out_degree / (out_degree + in_degree) >= 0.8
)"""


_EGOS = """
nb AS (
    SELECT DISTINCT b, src AS x, dst AS y FROM ed WHERE src <> dst
    UNION SELECT DISTINCT b, dst, src FROM ed WHERE src <> dst
), dk AS (
    SELECT b, x, count(*) AS k, list(y ORDER BY y) AS near FROM nb GROUP BY b, x
), tri AS (
    SELECT p.b, p.x, count(*) AS t
    FROM nb p JOIN nb q ON p.b = q.b AND p.x = q.x AND p.y < q.y
    JOIN nb r ON r.b = p.b AND r.x = p.y AND r.y = q.y
    GROUP BY p.b, p.x
), ego AS (
    SELECT dk.b, dk.x AS node, near, k + 1 AS node_count, k + coalesce(t, 0) AS ego_edges,
           (k + coalesce(t, 0)) / ((k + 1) * k / 2) AS density
    FROM dk LEFT JOIN tri ON tri.b = dk.b AND tri.x = dk.x
)"""


def _rings(size: int, density: float) -> str:
    """Nodes in order of first appearance, one after the other, skipping those covered."""
    return f"""
seen AS (
    SELECT b, node, min(place) AS place
    FROM (SELECT b, src AS node, 2 * seq AS place FROM ed UNION ALL SELECT b, dst, 2 * seq + 1 FROM ed)
    GROUP BY b, node
), fit AS (
    SELECT ego.*, row_number() OVER (PARTITION BY ego.b ORDER BY place) AS i
    FROM ego JOIN seen ON seen.b = ego.b AND seen.node = ego.node
    WHERE node_count >= {size} AND density >= {density}
), walk(b, i, covered, picked) AS (
    SELECT DISTINCT b, CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST(NULL AS VARCHAR) FROM fit
    UNION ALL
    SELECT walk.b, fit.i,
           CASE WHEN list_contains(covered, node) THEN covered ELSE list_concat(covered, near) END,
           CASE WHEN NOT list_contains(covered, node) THEN node END
    FROM walk JOIN fit ON fit.b = walk.b AND fit.i = walk.i + 1
), rings AS (
    SELECT fit.b, node AS seed_node, list_sort(list_append(near, node)) AS members,
           array_to_string(list_sort(list_append(near, node))[1:20], '|') AS nodes, node_count,
           round(density, 3) AS edge_density,
           CASE WHEN density > 0.8 THEN 'CRITICAL' ELSE 'HIGH' END AS severity
    FROM fit JOIN walk ON walk.b = fit.b AND walk.picked = fit.node
)"""


def _summary(key: str) -> str:
    return f"""
sm AS (
    SELECT {key} AS b, count(*) AS event_count, count(*) FILTER (social) AS social_count,
           count(*) FILTER (price) AS price_count,
           count(*) FILTER (social AND length(src) > 0 AND length(dst) > 0) AS edge_count,
           count(*) FILTER (social AND bot) AS bot_count,
           CASE WHEN count(*) FILTER (social) > 0
                THEN count(*) FILTER (social AND bot) / count(*) FILTER (social) ELSE 0.0 END AS ratio,
           coalesce(bool_or(price AND pump), false) AS pumping,
           coalesce(array_to_string(list_sort(list(DISTINCT symbol) FILTER (price AND pump)), '|'), '') AS tokens,
           coalesce(bool_or(social AND truth), false) AS truth
    FROM ev GROUP BY {key}
)"""


_SCORED = """
sc AS (
    SELECT sm.*, CASE WHEN edge_count >= 3 THEN coalesce(s.n, 0) ELSE 0 END AS star_count,
           CASE WHEN edge_count >= 3 THEN coalesce(r.n, 0) ELSE 0 END AS ring_count
    FROM sm LEFT JOIN (SELECT b, count(*) AS n FROM stars GROUP BY b) s ON s.b = sm.b
    LEFT JOIN (SELECT b, count(*) AS n FROM rings GROUP BY b) r ON r.b = sm.b
), sd AS (
    SELECT *, star_count + ring_count AS alert_count,
           CAST(3 * ring_count + 2 * star_count + CASE WHEN pumping THEN 3 ELSE 0 END + floor(ratio * 5) AS BIGINT)
           AS score
    FROM sc
), scored AS (
    SELECT *, CASE WHEN score >= 8 THEN 'CRITICAL' WHEN score >= 5 THEN 'HIGH'
                   WHEN score >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
           alert_count > 0 OR pumping AS persisted,
           CASE WHEN truth AND alert_count > 0 THEN 'TP' WHEN alert_count > 0 THEN 'FP'
                WHEN truth THEN 'FN' ELSE 'TN' END AS outcome
    FROM sd
)"""

_ALERTS = """
found AS (
    SELECT b, 'STAR_TOPOLOGY' AS alert_type, 'HIGH' AS severity, hub_node, out_degree, out_ratio,
           CAST(NULL AS VARCHAR) AS seed_node, CAST(NULL AS VARCHAR) AS nodes, CAST(NULL AS BIGINT) AS node_count,
           CAST(NULL AS DOUBLE) AS edge_density FROM stars
    UNION ALL
    SELECT b, 'CLIQUE_DETECTED', severity, NULL, NULL, NULL, seed_node, nodes, node_count, edge_density FROM rings
), al AS (
    SELECT f.b, alert_type, severity, confidence, CAST(pumping AS INTEGER) AS price_corroborated, tokens,
           edge_count, round(ratio, 3) AS bot_ratio, hub_node, out_degree, out_ratio, seed_node, nodes, node_count,
           edge_density, CAST(NULL AS BIGINT) AS social_alerts
    FROM found f JOIN scored s ON s.b = f.b WHERE edge_count >= 3
    UNION ALL
    SELECT b, 'PUMP_AND_DUMP_CONFIRMED', 'CRITICAL', 'CRITICAL', NULL, tokens, edge_count, NULL,
           NULL, NULL, NULL, NULL, NULL, NULL, NULL, alert_count
    FROM scored WHERE alert_count > 0 AND pumping
)"""

_ALERT_COLUMNS = """
    CAST(b AS VARCHAR) AS batch, alert_type, severity, confidence,
    coalesce(price_corroborated, 0) AS price_corroborated, tokens AS pumping_tokens,
    CAST(edge_count AS BIGINT) AS social_edge_count, CAST(coalesce(bot_ratio, 0) AS DOUBLE) AS gt_bot_ratio,
    strftime(b, '%Y-%m-%d 00:00:00') AS detected_at, coalesce(hub_node, '') AS hub_node,
    CAST(coalesce(out_degree, 0) AS BIGINT) AS out_degree, CAST(coalesce(out_ratio, 0) AS DOUBLE) AS out_ratio,
    coalesce(seed_node, '') AS seed_node, coalesce(nodes, '') AS nodes,
    CAST(coalesce(node_count, 0) AS BIGINT) AS node_count,
    CAST(coalesce(edge_density, 0) AS DOUBLE) AS edge_density,
    CAST(coalesce(social_alerts, 0) AS BIGINT) AS social_alerts"""

_NEWEST = "b DESC, alert_type, hub_node NULLS FIRST, seed_node NULLS FIRST"


_RESETS = """
reset_days AS (
    SELECT s.*, (SELECT max(e.day) FROM ev e WHERE e.kind = 'error' AND e.pump AND e.day <= s.b) AS epoch FROM scored s
)"""


def _quality(epoch: str = "", of: str = "scored") -> str:
    """Running counts over the days, from the start or from the start of each epoch."""
    group = f"PARTITION BY {epoch} " if epoch else ""
    return f"""
rq AS (
    SELECT *, CAST(count(*) FILTER (outcome = 'TP') OVER w AS BIGINT) AS tp,
           CAST(count(*) FILTER (outcome = 'FP') OVER w AS BIGINT) AS fp,
           CAST(count(*) FILTER (outcome = 'FN') OVER w AS BIGINT) AS fn, count(*) OVER w AS total
    FROM {of} WINDOW w AS ({group}ORDER BY b ROWS UNBOUNDED PRECEDING)
), rp AS (
    SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
           CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r
    FROM rq
), quality AS (
    SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM rp
)"""


_QUALITY_COLUMNS = """
    tp AS true_positives, fp AS false_positives, fn AS false_negatives, total AS total_batches,
    round(CAST(p AS DOUBLE), 3) AS "precision", round(CAST(r AS DOUBLE), 3) AS recall,
    round(CAST(f AS DOUBLE), 3) AS f1_score"""

_CANDLES = """
px AS (
    SELECT 'P' || (l_partkey % 15) AS symbol, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
           l_extendedprice / l_quantity AS px, l_quantity AS quantity, l_shipdate, l_orderkey, l_linenumber
    FROM lineitem
), cd AS (
    SELECT symbol, month, arg_min(px, (l_shipdate, l_orderkey, l_linenumber, px)) AS open, max(px) AS high,
           min(px) AS low, arg_max(px, (l_shipdate, l_orderkey, l_linenumber, px)) AS close,
           sum(quantity) AS volume, round(avg(px), 2) AS mean
    FROM px GROUP BY symbol, month
)"""

# Unicode white space and the ASCII separators.
_BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
_SKIP = (
    "'THE', 'FOR', 'AND', 'NOT', 'YOU', 'WITH', 'ARE', 'THIS', "
    "'WILL', 'NEXT', 'FROM', 'JUST', 'HAVE', 'THAT', 'BEEN'"
)
# The sharp s has two capital letters in one engine and one in the other.
_POSTS = rf"""
po AS (
    SELECT doc_id, source, CASE WHEN doc_id % 3 = 0
           THEN coalesce('@' || source || ' ', '') || coalesce('@' || lang || ' ', '') ELSE '' END || text AS t
    FROM documents
), wd AS (
    SELECT doc_id, source, regexp_split_to_array(t, '{_BLANK}') AS words,
           regexp_split_to_array(
               regexp_replace(upper(replace(t, 'ß', 'ss')), '[^\p{{L}}\s\x0b\x1c-\x1f\x85\p{{Z}}]+', '', 'g'), '{_BLANK}'
           ) AS letters
    FROM po
), tk AS (
    SELECT doc_id, source,
           list_transform(list_filter(words, lambda w: w[1] = '@' AND length(w) > 2), lambda w: w[2:]) AS mentions,
           list_filter(letters, lambda w: length(w) BETWEEN 2 AND 8 AND regexp_matches(w, '\p{{Lu}}')
                       AND NOT regexp_matches(w, '[\p{{Ll}}\p{{Lt}}]') AND w NOT IN ({_SKIP})) AS tickers
    FROM wd
)"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts)


_DAY = (_EVENTS, _edges("day"), _DEGREES, _stars(5), _EGOS, _rings(5, 0.6), _summary("day"), _SCORED)
_WEEK_RINGS = (_EVENTS, _edges("week"), _EGOS, _rings(4, 0.4))
_BATCH = "CAST(b AS VARCHAR) AS batch"
_SUMMARY_COLUMNS = """
    event_count, social_count, price_count, edge_count, bot_count, round(CAST(ratio AS DOUBLE), 6) AS gt_bot_ratio,
    CAST(pumping AS INTEGER) AS price_pumping, tokens AS pumping_tokens, CAST(truth AS INTEGER) AS ground_truth"""

SQL: dict[str, str] = {
    "decode_route_events": f"""{_with(_EVENTS)}
        SELECT CAST(day AS VARCHAR) AS batch, count(*) FILTER (social) AS social_count,
               count(*) FILTER (price) AS price_count, count(*) FILTER (social AND bot) AS bot_count,
               count(*) FILTER (price AND pump) AS pumping_count, count(*) AS event_count
        FROM ev GROUP BY day""",
    "interaction_edges": f"""{_with(_EVENTS, _edges("time_bucket(INTERVAL '10 minutes', ts)"))}
        SELECT strftime(b, '%Y-%m-%d %H:%M') AS batch, seq, src, dst
        FROM (SELECT *, count(*) OVER (PARTITION BY b) AS n FROM ed) WHERE n >= 3""",
    "degrees": f"""{_with(_EVENTS, _edges("week"), _DEGREES)}
        SELECT {_BATCH}, node, out_degree, in_degree FROM dg""",
    "undirected_edges": f"""{_with(_EVENTS, _edges("week"))}
        SELECT DISTINCT {_BATCH}, least(src, dst) AS a, greatest(src, dst) AS b FROM ed""",
    "star_hubs": f"""{_with(_EVENTS, _edges("week"), _DEGREES, _stars(10))}
        SELECT {_BATCH}, hub_node, out_degree, out_ratio, 'HIGH' AS severity FROM stars""",
    "ego_density": f"""{_with(_EVENTS, _edges("day"), _EGOS)}
        SELECT {_BATCH}, node, node_count, CAST(ego_edges AS BIGINT) AS ego_edges, round(density, 6) AS density
        FROM ego WHERE node_count >= 4""",
    "ring_alerts": f"""{_with(*_WEEK_RINGS)}
        SELECT {_BATCH}, seed_node, nodes, node_count, edge_density, severity FROM rings""",
    "ring_members": f"""{_with(*_WEEK_RINGS)}
        SELECT {_BATCH}, seed_node, unnest(members) AS member FROM rings""",
    "batch_summary": f"""{_with(_EVENTS, _summary("day"))}
        SELECT {_BATCH}, {_SUMMARY_COLUMNS} FROM sm""",
    "tumbling_summary": f"""{_with(_EVENTS, _summary("day"))}
        SELECT strftime(b, '%Y-%m-%d 00:00:00') AS window_start, {_SUMMARY_COLUMNS} FROM sm""",
    "batch_confidence": f"""{_with(*_DAY)}
        SELECT {_BATCH}, CAST(star_count AS BIGINT) AS star_count, CAST(ring_count AS BIGINT) AS ring_count,
               score, confidence FROM scored""",
    "alerts_enriched": f"{_with(*_DAY, _ALERTS)} SELECT {_ALERT_COLUMNS} FROM al",
    "batch_status": f"""{_with(*_DAY, _quality())}
        SELECT {_BATCH},
               '[Batch ' || CAST(b AS VARCHAR) || '] ' || CASE WHEN alert_count > 0 THEN '[ANOMALY]' ELSE '[CLEAN]' END || ' | social=' || social_count
               || ' price=' || price_count || ' | alerts=' || alert_count || ' conf=' || confidence
               || ' | P=' || CAST(round(CAST(round(p, 3) AS DECIMAL(6, 3)), 2) AS DECIMAL(6, 2))
               || ' R=' || CAST(round(CAST(round(r, 3) AS DECIMAL(6, 3)), 2) AS DECIMAL(6, 2))
               || ' F1=' || CAST(round(CAST(round(f, 3) AS DECIMAL(6, 3)), 2) AS DECIMAL(6, 2)) AS status,
               CAST(persisted AS INTEGER) AS persisted
        FROM quality""",
    "outcomes": f"""{_with(*_DAY)}
        SELECT {_BATCH}, CAST(truth AS INTEGER) AS ground_truth, CAST(alert_count > 0 AS INTEGER) AS detected, outcome
        FROM scored""",
    "running_quality": f"{_with(*_DAY, _quality())} SELECT {_BATCH}, {_QUALITY_COLUMNS} FROM quality",
    "quality_snapshot": f"""{_with(*_DAY, _quality())}
        SELECT {_QUALITY_COLUMNS}, round(round(p, 3) * 100, 3) AS precision_pct,
               round(round(r, 3) * 100, 3) AS recall_pct, round(round(f, 3) * 100, 3) AS f1_score_pct,
               printf('%.1f%%', round(p, 3) * 100) AS precision_card
        FROM quality ORDER BY b DESC LIMIT 1""",
    "stored_snapshot": f"""{_with(*_DAY, _quality())}
        SELECT {_QUALITY_COLUMNS}, CAST(b AS VARCHAR) AS updated_at
        FROM quality WHERE persisted ORDER BY b DESC LIMIT 1""",
    "quality_epochs": f"""{_with(*_DAY, _quality("(b - DATE '2024-01-01') // 10"))}
        SELECT CAST((b - DATE '2024-01-01') // 10 AS BIGINT) AS epoch, {_BATCH}, {_QUALITY_COLUMNS} FROM quality""",
    "quality_resets": f"""{_with(*_DAY, _RESETS, _quality("epoch", "reset_days"))}
        SELECT coalesce(CAST(epoch AS VARCHAR), '') AS epoch, {_BATCH}, {_QUALITY_COLUMNS} FROM quality""",
    "candles_body_pump": f"""{_with(_CANDLES)}
        SELECT 'price_candle' AS event_type, symbol, CAST(month AS VARCHAR) AS timestamp, open, high, low, close, volume,
               abs(close - open) / open * 100 AS body_pct,
               CAST(abs(close - open) / open * 100 > 10 AS INTEGER) AS pumping, 'kaggle_ohlcv' AS source
        FROM cd""",
    "ohlcv_headers_symbols": f"""{_with(_CANDLES)}
        SELECT CAST(month AS VARCHAR) AS date, 'coin_' || symbol || '_price.csv' AS file, symbol,
               symbol AS file_symbol, 'COIN_' || symbol AS coin
        FROM cd""",
    "poll_spikes": f"""{_with(_CANDLES)}, pv AS (
            SELECT symbol, month, mean, coalesce(lag(mean) OVER (PARTITION BY symbol ORDER BY month), mean) AS prev FROM cd
        ), pc AS (
            SELECT *, CASE WHEN prev > 0 THEN (mean - prev) / prev * 100 ELSE 0.0 END AS change FROM pv
        )
        SELECT symbol AS token, CAST(month AS VARCHAR) AS poll_ts, mean AS price_usd, prev AS previous_price,
               round(change, 4) AS change_since_last_poll_pct, CAST(abs(change) >= 10 AS INTEGER) AS pumping
        FROM pc""",
    "snapshot_flatten": f"""{_with(_CANDLES)}
        SELECT CAST(month AS VARCHAR) AS poll_ts, 'coin-' || symbol[2:] AS token, 'COIN_' || symbol[2:] AS symbol,
               mean AS price_usd, CASE WHEN volume > 600 THEN volume ELSE 0.0 END AS volume_24h_usd,
               CAST(0 AS DOUBLE) AS change_24h_pct
        FROM cd""",
    "topic_records": f"""{_with(_EVENTS)}
        SELECT src AS key, 1 AS keeps_nulls, dst AS target_user, kind AS interaction_type,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, CAST(bot AS INTEGER) AS is_bot,
               CAST(truth AS INTEGER) AS pump_signal
        FROM ev WHERE social""",
    "tweet_mentions": f"""{_with(_POSTS)}
        SELECT doc_id, coalesce(array_to_string(mentions, '|'), '') AS mentions,
               CAST(len(mentions) AS INTEGER) AS n_mentions FROM tk""",
    "tweet_tokens": f"""{_with(_POSTS)}, ft AS (
            SELECT doc_id, w, min(i) AS i
            FROM (SELECT doc_id, unnest(tickers) AS w, generate_subscripts(tickers, 1) AS i FROM tk) GROUP BY doc_id, w
        ), ds AS (SELECT doc_id, list(w ORDER BY i) AS tokens FROM ft GROUP BY doc_id)
        SELECT documents.doc_id, coalesce(array_to_string(tokens, '|'), '') AS tokens,
               CAST(coalesce(len(tokens), 0) AS INTEGER) AS n_tokens
        FROM documents LEFT JOIN ds ON ds.doc_id = documents.doc_id""",
    "tweet_edges": f"""{_with(_POSTS)}, tg AS (
            SELECT *, CASE WHEN len(mentions) > 0 THEN mentions ELSE ['crypto_community'] END AS targets FROM tk
        )
        SELECT doc_id, CAST(generate_subscripts(targets, 1) - 1 AS INTEGER) AS position,
               'social_interaction' AS event_type, 'tw_' || source AS source_user,
               'tw_' || unnest(targets) AS target_user, 'tweet_mention' AS interaction_type,
               coalesce(tickers[1], '') AS token_mentioned, '2024-01-01' AS timestamp, 'kaggle_tweets' AS source
        FROM tg""",
    "tweet_csv_edges": f"""{_with(_POSTS)}, tg AS (
            SELECT *, CASE WHEN len(mentions) > 0 THEN mentions ELSE ['crypto_community'] END AS targets FROM tk
        )
        SELECT 'tw_' || source AS source_user, 'tw_' || unnest(targets) AS target_user,
               coalesce(tickers[1], '') AS token_mentioned,
               strftime(TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 20000 AS INTEGER)), '%Y-%m-%d') AS day
        FROM tg""",
    "ohlcv_csv_candles": f"""{_with(_CANDLES)}
        SELECT symbol, CAST(month AS VARCHAR) AS day, open, high, low, close, volume,
               CAST(abs(close - open) / open * 100 > 10 AS INTEGER) AS pumping
        FROM cd""",
    "alert_table_first": f"""{_with(*_DAY, _ALERTS)}
        SELECT detected_at, alert_type, severity, confidence, social_edge_count, hub_node, node_count, edge_density,
               price_corroborated, pumping_tokens
        FROM (SELECT {_ALERT_COLUMNS} FROM (SELECT * FROM al WHERE severity IN ('CRITICAL', 'HIGH') ORDER BY {_NEWEST} LIMIT 50))""",
    "latest_alerts": f"""{_with(*_DAY, _ALERTS)}
        SELECT {_ALERT_COLUMNS} FROM (SELECT * FROM al ORDER BY {_NEWEST} LIMIT 300)""",
    "alert_kpis": f"""{_with(*_DAY, _ALERTS)}
        SELECT count(*) AS total, count(*) FILTER (severity = 'CRITICAL') AS critical,
               count(*) FILTER (severity = 'HIGH') AS high,
               count(*) FILTER (alert_type = 'PUMP_AND_DUMP_CONFIRMED') AS confirmed FROM al""",
    "alerts_by_type": f"{_with(*_DAY, _ALERTS)} SELECT alert_type, count(*) AS count FROM al GROUP BY alert_type",
    "alerts_timeline": f"""{_with(*_DAY, _ALERTS)}
        SELECT strftime(b, '%Y-%m-%d 00:00:00') AS detected_at, alert_type, count(*) AS count
        FROM al GROUP BY b, alert_type""",
    "top_tokens": f"""{_with(*_DAY, _ALERTS)}
        SELECT token, count(*) AS alert_count
        FROM (SELECT unnest(string_split(tokens, '|')) AS token FROM al) WHERE length(token) > 0
        GROUP BY token ORDER BY alert_count DESC, token LIMIT 10""",
    "alert_table": f"""{_with(*_DAY, _ALERTS)}
        SELECT detected_at, alert_type, severity, confidence, social_edge_count, hub_node, node_count, edge_density,
               price_corroborated, pumping_tokens
        FROM (SELECT {_ALERT_COLUMNS} FROM al) WHERE severity IN ('CRITICAL', 'HIGH')""",
    "dataset_stats": """
        SELECT 'events' AS dataset, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows FROM events
        UNION ALL SELECT 'lineitem', 1, count(*) FROM lineitem
        UNION ALL SELECT 'documents', 1, count(*) FROM documents""",
}
