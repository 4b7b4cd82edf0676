"""The queries of ``parts`` again, in DuckDB's SQL."""

from __future__ import annotations

from ..functions import domain as D
from ..functions.text import keyword_form_of
from ..operators import mapping
from ..operators.labels import IGNORED
from ..sources import files
from . import parts as P
from .catalogue import LABELS, RULES
from .oracles import LABEL_IDS, LOCATED, ORACLES as MAIN
from .oracles import TOKENS, TYPE_NAME, choose, entities, listed, q, tagged, templates_sql, uniform, window_rows


def values(rows: list[tuple], names: str) -> str:
    body = ", ".join("(" + ", ".join("NULL" if v is None else str(v) if isinstance(v, int) else q(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


def mapping_rows() -> list[tuple]:
    out = [(s, t, e, f) for s, sets in (("sdk", mapping.DEFAULT_MAPPINGS), ("repo", mapping.REPO_MAPPINGS)) for t, m in sets.items() for e, f in m.items()]
    seen = {}
    for label in LABELS:
        if label[:2] in ("B-", "I-"):
            seen.setdefault(label[2:].replace("_VALUE", "").upper(), label[2:])
    return out + [("labels", "x", e, f) for e, f in seen.items()]


IDS = """n AS (SELECT doc_id, CAST(len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda t: t <> '')) AS BIGINT) AS n FROM documents),
ids AS (SELECT doc_id, n, list_transform(range(0, n), lambda i: i % 97 + 3) AS ids, list_transform(range(0, n), lambda i: i % 5) AS label_ids FROM n)"""
FRAMED = f"""{IDS}, w AS (SELECT *, unnest(range(0, CAST(1 + greatest(ceil((n - 254) / 126.0), 0) AS BIGINT))) AS win FROM ids WHERE n > 0),
s AS (SELECT doc_id, win, ids[win * 126 + 1:least(win * 126 + 254, n)] AS i, label_ids[win * 126 + 1:least(win * 126 + 254, n)] AS l FROM w),
framed AS (SELECT doc_id, win, list_concat([0], i, [2], list_transform(range(0, 254 - len(i)), lambda x: 1)) AS input_ids, list_concat(list_transform(range(0, len(i) + 2), lambda x: 1), list_transform(range(0, 254 - len(i)), lambda x: 0)) AS attention_mask,
  list_concat([{IGNORED}], l, [{IGNORED}], list_transform(range(0, 254 - len(i)), lambda x: {IGNORED})) AS labels FROM s)"""
sha = lambda c: f"sha256(array_to_string({c}, ',')) AS {c}"

PREDICTED = f"""WITH {TOKENS}, pieces AS (SELECT doc_id, tok_idx, token, start, "end", list_transform(range(0, CAST(ceil(length(token) / 3.0) AS BIGINT)), lambda i: ord(substr(token, i * 3 + 1, 1)) % 101) AS ids FROM tok),
tags AS (SELECT doc_id, tok_idx, token, start, "end", ({listed(P.NAME_LABELS)})[ids[1] % 3 + 1] AS label, list_avg(list_transform(ids, lambda i: (i % 64) / 64.0)) AS conf FROM pieces)"""

SAMPLE_TAGS = f"""({tagged(False)})"""
KNOWN = f"""WITH {LOCATED}, known AS (SELECT doc_id, count(*) FILTER (item_id % 3 = 0) AS n_known, count(*) FILTER (item_id % 3 <> 0) AS n_unknown FROM spans GROUP BY doc_id)"""


def registered_sql() -> str:
    rules = {t: {**kinds, "exclude": [*kinds["exclude"], *P.CARD["strong"]]} for t, kinds in RULES.items()}
    rules["card"] = {**P.CARD, "exclude": [w for kinds in RULES.values() for w in kinds["strong"]]}
    scores = []
    for i, (t, kinds) in enumerate(rules.items()):
        terms = [f"CASE WHEN contains(norm, {q(keyword_form_of(w))}) THEN {x} ELSE 0 END" for kind, x in (("strong", "3.0::DOUBLE"), ("weak", "1.0::DOUBLE"), ("exclude", "-10.0::DOUBLE")) for w in kinds[kind]]
        scores.append(f"SELECT doc_id, {i} AS ord, '{t}' AS doc_type, greatest({' + '.join(terms)}, 0) AS score FROM normed")
    return f"""WITH normed AS (SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')) AS norm FROM documents), scores AS ({' UNION ALL '.join(scores)}),
b AS (SELECT doc_id, sum(score) AS total, arg_min(doc_type, struct_pack(a := -score, b := ord)) AS best, max(score) AS top FROM scores GROUP BY doc_id), s AS (SELECT *, CASE WHEN total > 0 THEN round(top / total, 4) ELSE 0 END AS share FROM b)
SELECT doc_id, CASE WHEN total > 0 AND share >= 0.25 THEN best END AS doc_type, share AS confidence, total > 0 AND share >= 0.25 AS is_confident, CASE WHEN total > 0 THEN 'keyword' ELSE 'none' END AS method FROM s"""


def explain_sql() -> str:
    parts = [f"SELECT doc_id, '{t}' AS doc_type, '{kind}' AS kind, coalesce(list_aggregate(list_filter({listed(words)}, lambda w: contains(norm, w)), 'string_agg', '|'), '') AS matched FROM normed" for t, kinds in RULES.items() for kind, words in kinds.items() if words]
    return f"WITH normed AS (SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')) AS norm FROM documents) {' UNION ALL '.join(parts)}"


def fold_sql() -> str:
    """The fold in order; means are rounded half up as they are written."""
    mean = "CAST(round(CAST(CAST((a.c + x.c) / 2 AS VARCHAR) AS DECIMAL(30, 20)), 4) AS DOUBLE)"
    text = "CASE WHEN contains(a.t, x.t) THEN a.t ELSE a.t || ' ' || x.t END"
    fold = f"list_reduce(p, lambda a, x: struct_pack(o := a.o, t := {text}, s := a.s, e := greatest(a.e, x.e), c := {mean}))"
    return f"""WITH {entities()}, gathered AS (SELECT doc_id, type, list(struct_pack(o := ord, t := text, s := start, e := "end", c := confidence) ORDER BY ord) AS p FROM ent GROUP BY doc_id, type),
done AS (SELECT doc_id, type, CASE WHEN type IN ('ADDRESS', 'NOTES') THEN {fold} ELSE p[1] END AS x FROM gathered)
SELECT doc_id, x.o AS ord, type, x.t AS text, x.s AS start, x.e AS "end", x.c AS confidence FROM done"""


def noise_tokens_sql() -> str:
    u = lambda s: uniform("42", "item_id", "i", q(s))
    token = choose(D.NOISE_TOKENS, u("token"))
    return f"""WITH lines AS (SELECT item_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM benchmark),
made AS (SELECT item_id, string_agg(CASE WHEN trim(x) <> '' AND {u('line')} < 0.25 THEN CASE WHEN {u('side')} < 0.5 THEN {token} || ' ' || x ELSE x || ' ' || {token} END ELSE x END, chr(10) ORDER BY i) AS new FROM lines GROUP BY item_id)
SELECT item_id, CASE WHEN hit THEN new ELSE text END AS text, CASE WHEN hit AND instr(new, value) > 0 THEN instr(new, value) - 1 ELSE 4 END AS start
FROM (SELECT item_id, text, new, substr(text, 5, 8) AS value, {uniform('42', 'item_id', q('noise'))} < 0.5 AS hit FROM benchmark JOIN made USING (item_id))"""


ENT_OF_PREDICTED = entities().split("closed AS", 1)[1]
FIRST_VALID = MAIN["first_valid_entities"]
SHUFFLED = "r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents)"
U = lambda key, s: uniform("42", key, q(s))

SCHEMAS = """schemas AS (SELECT lower(replace(r_name, ' ', '_')) AS doc_type, CAST(n_nationkey AS BIGINT) AS ord, lower(replace(n_name, ' ', '_')) AS field FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT DISTINCT lower(replace(c_mktsegment, ' ', '_')), CAST(c_nationkey AS BIGINT), 'nation_' || c_nationkey FROM customer)"""

ORACLES = {
    "merge_entities_fold": fold_sql(),
    "ocr_noise_tokens": noise_tokens_sql(),
    "mapping_defaults": f"""WITH k AS ({values(mapping_rows(), "variant, doc_type, etype, field")}), {entities()}, c AS (SELECT type, count(*) AS n FROM ent GROUP BY type) SELECT variant, doc_type, etype, field, coalesce(n, 0) AS n FROM k LEFT JOIN c ON etype = type""",
    "json_mapping": f"""WITH f AS ({FIRST_VALID}) SELECT doc_id, '{{' || string_agg(to_json(lower(type)) || ':' || to_json(text), ',' ORDER BY lower(type)) || '}}' AS record FROM f GROUP BY doc_id""",
    "run_errors": """WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 10) / 10.0 END AS f FROM orders),
s AS (SELECT CASE WHEN k % 13 = 0 THEN 'error' WHEN k % 11 = 0 THEN 'generate_failed' WHEN k % 7 = 0 THEN 'train_failed' WHEN coalesce(f, 0) < 0.2 THEN 'low_f1' WHEN k % 5 = 0 THEN 'no_hf_token' WHEN k % 3 = 0 THEN 'publish_failed' ELSE 'published' END AS status FROM o) SELECT status, count(*) AS n FROM s GROUP BY status""",
    "label_maps": f"WITH tags AS ({tagged(True)}), {LABEL_IDS} SELECT string_agg(label || '=' || id, ',' ORDER BY label) AS label2id, string_agg(id || '=' || label, ',' ORDER BY id) AS id2label FROM ids",
    "resplit_train_valid": f"WITH {SHUFFLED} SELECT doc_id, CASE WHEN r <= floor(n * 0.1::DOUBLE / (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'valid' ELSE 'train' END AS split FROM r",
    "shuffled_order": f"WITH {SHUFFLED} SELECT (r - 1) // 10 AS tenth, min(doc_id) AS low, max(doc_id) AS high, count(*) AS n FROM r GROUP BY (r - 1) // 10",
    "train_window_arrays": f"WITH {FRAMED} SELECT doc_id, win, {sha('input_ids')}, {sha('attention_mask')}, {sha('labels')} FROM framed",
    "truncated_arrays": f"WITH {IDS} SELECT doc_id, len(ids[1:128]) AS n, sha256(array_to_string(ids[1:128], ',')) AS cut FROM ids",
    "label_range": f"WITH {FRAMED} SELECT CAST(sum(len(list_filter(labels, lambda x: x >= 4))) AS BIGINT) AS n_bad, count(*) AS n_windows FROM framed",
    "predict_windows": f"""{PREDICTED}, closed AS{ENT_OF_PREDICTED} SELECT * FROM ent""",
    "bio_samples": f"""WITH t AS {SAMPLE_TAGS}, g AS (SELECT doc_id, count(*) AS n, string_agg(token, ' ' ORDER BY tok_idx) AS tokens, string_agg(label, ' ' ORDER BY tok_idx) AS tags, bool_or(label LIKE '%-alpha') AS a, bool_or(label LIKE '%-beta') AS b FROM t GROUP BY doc_id)
SELECT doc_id, n, sha256(tokens) AS tokens, sha256(tags) AS ner_tags, CASE WHEN a AND b THEN '' WHEN a THEN 'beta' WHEN b THEN 'alpha' ELSE 'alpha,beta' END AS missing FROM g""",
    "known_annotations": f"{KNOWN} SELECT doc_id, coalesce(n_known, 0) AS n_known, coalesce(n_unknown, 0) AS n_unknown FROM documents LEFT JOIN known USING (doc_id) WHERE text <> ''",
    "annotation_samples": f"""WITH t AS (SELECT * FROM ({tagged(False).replace("FROM documents d, benchmark b WHERE", "FROM documents d, benchmark b WHERE b.item_id % 3 = 0 AND")})) SELECT label, count(*) AS n FROM t GROUP BY label""",
    "example_sample": f"""WITH t AS {SAMPLE_TAGS}, g AS (SELECT doc_id, bool_or(label <> 'O') AS any_tag FROM t GROUP BY doc_id), c AS (SELECT doc_id FROM g ORDER BY any_tag DESC, doc_id LIMIT 1)
SELECT doc_id, string_agg(token, ' ' ORDER BY tok_idx) AS tokens, string_agg(label, ' ' ORDER BY tok_idx) AS ner_tags FROM t JOIN c USING (doc_id) WHERE tok_idx < 20 GROUP BY doc_id""",
    "template_shape": f"""WITH {templates_sql()}, f AS (SELECT doc_type, unnest(regexp_extract_all(body, '\\{{\\{{\\s*(\\w+)\\s*(\\.upper\\(\\))?\\s*\\}}\\}}', 1)) AS field FROM t)
SELECT n.doc_type, n_templates, coalesce(fields, '') AS fields FROM (SELECT doc_type, count(DISTINCT idx) AS n_templates FROM t GROUP BY doc_type) n LEFT JOIN (SELECT doc_type, string_agg(DISTINCT field, ',' ORDER BY field) AS fields FROM f GROUP BY doc_type) g USING (doc_type)""",
    "template_choice": f"SELECT c_custkey, CAST(floor({U('c_custkey', 'template')} * 3) AS BIGINT) AS drawn, CAST(c_custkey % 3 AS BIGINT) AS given FROM customer",
    "line_noise": f"SELECT p_partkey, CASE WHEN {U('p_partkey', 'line')} < 0.3 THEN CASE WHEN {U('p_partkey', 'side')} < 0.5 THEN {choose(D.NOISE_TOKENS, U('p_partkey', 'token'))} || ' ' || p_name ELSE p_name || ' ' || {choose(D.NOISE_TOKENS, U('p_partkey', 'token'))} END ELSE p_name END AS text FROM part",
    "schema_rules": f"""WITH {SCHEMAS} SELECT doc_type, 'weak' AS kind, replace(field, '_', ' ') AS keyword, ord FROM schemas""",
    "rules_by_precedence": f"""WITH {SCHEMAS} SELECT 'templates' AS given, 'templates' AS origin, (SELECT string_agg(DISTINCT lower(p_type), ',' ORDER BY lower(p_type)) FROM part) AS types, true AS has_index
UNION ALL SELECT 'rules', 'version 1', 'de,en,es,fr', false UNION ALL SELECT 'schemas', 'schemas', (SELECT string_agg(DISTINCT doc_type, ',' ORDER BY doc_type) FROM schemas), false
UNION ALL SELECT 'nothing', 'built-in', 'cccd,giay_khai_sinh,giay_ra_vien,gplx,vehicle_registration', false""",
    "detect_explain": explain_sql(),
    "detect_registered": registered_sql(),
    "registry_register": f"""WITH n AS (SELECT *, {TYPE_NAME} AS t FROM nation), m AS (SELECT t AS doc_type, n_nationkey % 2 = 0 OR n_regionkey = 1 AS hub_verified, CASE WHEN n_regionkey = 1 THEN 'registered' WHEN n_nationkey % 3 = 0 THEN 'local' ELSE 'remote' END AS source FROM n)
SELECT * FROM m WHERE hub_verified OR source = 'local'""",
    "registry_lookup": f"WITH n AS (SELECT *, {TYPE_NAME} AS t FROM nation) SELECT t AS doc_type, n_nationkey FROM n WHERE t = 'china' UNION ALL SELECT min(t), NULL FROM n",
    "hub_listing": "WITH c AS (SELECT lower(replace(c_mktsegment, ' ', '_')) || '-' || c_custkey AS t FROM customer WHERE c_custkey % 4 = 0 AND c_custkey % 3 = 0) SELECT t AS doc_type, 'me/phobert-' || t || '-ner' AS repo_id FROM c",
    "model_file_lists": f"""WITH l AS (SELECT 'm' || c_custkey || '/' || ({listed(P.MODEL_FILES)})[c_custkey % {len(P.MODEL_FILES)} + 1] AS path FROM customer)
SELECT path, 'kept' AS kind FROM l WHERE split_part(path, '/', -1) IN ({listed(files.INFERENCE_FILES)[1:-1]}) UNION ALL SELECT path, 'junk' FROM l WHERE {' OR '.join(f"contains(path, {q(j)})" for j in files.JUNK)}""",
    "stale_types": "SELECT DISTINCT lower(c_mktsegment) AS doc_type FROM customer UNION ALL SELECT lower(n_name) FROM nation WHERE n_regionkey >= 3",
    "legacy_f1": f"SELECT precision, recall, f1, '' AS by_type FROM ({MAIN['entity_f1']}) WHERE type IS NULL",
    "located_labels": """WITH c AS (SELECT c_custkey, c_name, c_mktsegment AS m, 'Name ' || c_name || ' Segment ' || CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'none' END || '.' AS t FROM customer)
SELECT c_custkey, 'name' AS label, 'LABEL' AS role, 0 AS start, 4 AS "end" FROM c UNION ALL SELECT c_custkey, 'name', 'VALUE', 5, 5 + length(c_name) FROM c
UNION ALL SELECT c_custkey, 'segment', 'LABEL', instr(t, 'Segment') - 1, instr(t, 'Segment') + 6 FROM c UNION ALL SELECT c_custkey, 'segment', 'VALUE', instr(t, m) - 1, instr(t, m) - 1 + length(m) FROM c WHERE c_custkey % 2 = 0""",
}
