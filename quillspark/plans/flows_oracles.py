"""The queries of ``flows`` in DuckDB's SQL."""

from __future__ import annotations

from . import flows as P
from .oracles import ORACLES as MAIN
from .oracles import TOKENS, choose, q, split_sql, uniform
from .parts_oracles import ORACLES as PARTS


def serving_sql() -> str:
    order = ", ".join(f"({i}, {q(t)})" for i, t in enumerate(P.TAGS))
    return f"""WITH {TOKENS}, pieces AS (SELECT doc_id, token, unnest(list_transform(range(0, CAST(ceil(length(token) / 3.0) AS BIGINT)), lambda i: ord(substr(token, i * 3 + 1, 1)) % 101)) % {P.BUCKETS} AS bucket FROM tok),
lab AS (SELECT doc_id, bucket, CASE WHEN regexp_matches(token, '^[A-Z]') THEN 'B-name' WHEN starts_with(token, 't') THEN 'I-name' ELSE 'O' END AS label FROM pieces),
names AS (SELECT * FROM (VALUES {order}) v(place, label)), counts AS (SELECT bucket, label, count(*) AS n FROM lab GROUP BY ALL),
totals AS (SELECT label, place, coalesce(sum(n), 0)::DOUBLE AS total FROM names LEFT JOIN counts USING (label) GROUP BY ALL),
scores AS (SELECT b.bucket, t.label, t.place, ln(coalesce(c.n, 0) + 1) - ln(t.total + {P.BUCKETS}) + ln(t.total + 1) AS s FROM (SELECT unnest(range({P.BUCKETS})) AS bucket) b CROSS JOIN totals t LEFT JOIN counts c ON c.bucket = b.bucket AND c.label = t.label),
shifted AS (SELECT *, exp(s - max(s) OVER (PARTITION BY bucket)) AS e FROM scores),
best AS (SELECT bucket, label, e / sum(e) OVER (PARTITION BY bucket) AS conf FROM shifted QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY e DESC, place) = 1)
SELECT doc_id, count(*) AS n, count(*) FILTER (b.label = 'O') AS n_o, count(*) FILTER (b.label = 'B-name') AS n_b, count(*) FILTER (b.label = 'I-name') AS n_i, round(min(conf), 4) AS least_conf, round(max(conf), 4) AS most_conf
FROM lab l JOIN best b ON l.bucket = b.bucket GROUP BY doc_id"""


def lines_sql() -> str:
    value = {"name": "c_name", "segment": "c_mktsegment", "nation": "CAST(c_nationkey AS VARCHAR)", "key": "CAST(c_custkey AS VARCHAR)"}
    u = lambda *slots: uniform("42", "c_custkey", *map(q, slots))
    piece = lambda s, field=None, role=None: f"struct_pack(s := {s}, label := {q(field) if field else 'NULL::VARCHAR'}, role := {q(role) if role else 'NULL::VARCHAR'})"
    empty = lambda v: f"coalesce({v}, {q('')})"
    parts = []
    joins, follows = {a: (b, x) for a, b, x in P.MERGED}, {b: (a, x) for a, b, x in P.MERGED}
    for f in P.SPELLINGS:
        separator = choose(P.SEPARATORS, u("separator", f))
        own = lambda g, sep=separator: f"[{piece(choose(P.SPELLINGS[g], u('label', g)), g, 'LABEL')}, {piece(sep)}, {piece(empty(value[g]), g, 'VALUE')}]"
        pieces = own(f)
        if f in joins:
            other, share = joins[f]
            two_blanks = piece(q("  "))
            pieces = f"CASE WHEN {u('merge', f)} < {share} THEN list_concat({pieces}, [{two_blanks}], {own(other)}) ELSE {pieces} END"
        alone = f"{u('merge', follows[f][0])} >= {follows[f][1]}" if f in follows else "true"
        parts.append(f"SELECT c_custkey, {u('order', f)} AS o, {q(f)} AS field, {pieces} AS p FROM customer WHERE {alone}")
    return f"""WITH lines AS ({' UNION ALL '.join(parts)}),
ordered AS (SELECT c_custkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o, field) AS r, p FROM lines),
broken AS (SELECT c_custkey, r, CASE WHEN r > 1 THEN list_concat([{piece('chr(10)')}], p) ELSE p END AS p FROM ordered),
flat AS (SELECT c_custkey, r, unnest(p) AS x, generate_subscripts(p, 1) AS j FROM broken),
placed AS (SELECT c_custkey, r, j, x.s AS s, x.label AS label, x.role AS role, sum(length(x.s)) OVER (PARTITION BY c_custkey ORDER BY r, j) AS e FROM flat)
SELECT c_custkey, string_agg(s, '' ORDER BY r, j) AS text, string_agg(label || ':' || role || ':' || (e - length(s)) || ':' || e, ',' ORDER BY r, j) FILTER (role IS NOT NULL AND length(s) > 0) AS spans FROM placed GROUP BY c_custkey"""


CARD = f"""{split_sql()}, t AS (SELECT split, lang, source FROM documents JOIN split USING (doc_id)),
card AS (SELECT concat_ws(',', CASE WHEN grouping(split) = 0 THEN 'split' END, CASE WHEN grouping(lang) = 0 THEN 'lang' END, CASE WHEN grouping(source) = 0 THEN 'source' END) AS level, split, lang, source, count(*) AS n
  FROM t GROUP BY GROUPING SETS ((), (split), (lang), (source), (split, lang), (split, source)))"""

ORACLES = {
    "json_array_scan": "SELECT doc_id, sha256(text) AS text, lang, source FROM documents",
    "annotation_files": PARTS["annotation_samples"],
    "model_serving": serving_sql(),
    "legacy_lines": lines_sql(),
    "index_versions": f"SELECT *, CAST(2 AS BIGINT) AS version, 'version 2' AS origin FROM ({MAIN['tfidf_weights_lang']})",
    "registry_as_of": f"""WITH v AS (SELECT * FROM events WHERE event_type = 'view'), a AS (SELECT * FROM events WHERE event_type <> 'view'),
c AS (SELECT a.event_id, v.event_id AS entry, v.ts AS since FROM a JOIN v ON a.user_id = v.user_id AND v.ts <= a.ts QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY v.ts DESC, v.event_id DESC) = 1)
SELECT a.event_id, CASE WHEN epoch_us(a.ts) - epoch_us(c.since) <= {P.TTL}::BIGINT * 1000000 THEN c.entry END AS entry FROM a LEFT JOIN c ON a.event_id = c.event_id""",
    "registry_refresh": """WITH n AS (SELECT event_type, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS version FROM events GROUP BY event_type)
SELECT event_type AS doc_type, '{"owner":"me","doc_type":"' || event_type || '","name":"' || upper(event_type[1:1]) || event_type[2:] || '","version":' || version || '}' AS json FROM n""",
    "training_runs": """WITH c AS (SELECT c_nationkey, count(*) AS n, round(avg(CASE WHEN c_acctbal > 6500 THEN 1.0 ELSE 0.0 END), 4) AS share FROM customer GROUP BY c_nationkey),
f AS (SELECT lower(replace(n_name, ' ', '_')) AS doc_type, n_nationkey AS k, coalesce(n, 0) AS n, coalesce(share, 0.0) AS share FROM nation LEFT JOIN c ON n_nationkey = c_nationkey)
SELECT doc_type, CASE WHEN n = 0 THEN 'generate_failed' WHEN k % 5 = 0 THEN 'train_failed' WHEN share < 0.2 THEN 'low_f1' ELSE 'published' END AS status, CASE WHEN n > 0 AND k % 5 <> 0 THEN CAST(share AS DOUBLE) END AS f1,
  CAST(CASE WHEN n = 0 THEN 2 WHEN k % 5 = 0 THEN 3 WHEN share < 0.2 THEN 3 WHEN k % 7 = 0 THEN 5 ELSE 4 END AS BIGINT) AS n_attempts FROM f""",
    "split_files": f"""WITH {split_sql()}, n AS (SELECT doc_id, lang, CAST(len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda t: t <> '')) AS BIGINT) AS t FROM documents)
SELECT split, lang, count(*) AS n, CAST(sum(t) AS BIGINT) AS n_tokens, min(doc_id) AS low, max(doc_id) AS high FROM n JOIN split USING (doc_id) GROUP BY split, lang""",
    "stream_sessions": """WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS o FROM events),
g AS (SELECT user_id, ts, sum(o) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM s)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 1 HOUR AS "end", count(*) AS n FROM g GROUP BY user_id, g HAVING max(ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
    "dataset_card_rows": f"WITH {CARD} SELECT * FROM card",
    "dataset_card_text": f"""WITH {CARD}, lines AS (SELECT level, '| ' || concat_ws(' | ', CASE WHEN contains(level, 'split') THEN coalesce(split, '-') END, CASE WHEN contains(level, 'lang') THEN coalesce(lang, '-') END, CASE WHEN contains(level, 'source') THEN coalesce(source, '-') END, n::VARCHAR) || ' |' AS line FROM card WHERE level <> ''),
tables AS (SELECT '## ' || level || chr(10) || string_agg(line, chr(10) ORDER BY line) AS t FROM lines GROUP BY level)
SELECT '# documents' || chr(10) || (SELECT max(n) FROM card WHERE level = '') || ' rows' || chr(10) || string_agg(t, chr(10) ORDER BY t) AS card FROM tables""",
}
