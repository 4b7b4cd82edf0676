"""The queries of the facade in DuckDB's SQL."""

from __future__ import annotations

from ..operators import clean as C
from ..operators.mapping import DEFAULT_MAPPINGS
from . import facade_queries as P
from .oracles import CLEANED, TIDY, entities, keyword_sql, listed, pseudo, q, strip
from .parts_oracles import values

DEFAULTS = [(t, i, e, f) for t, m in DEFAULT_MAPPINGS.items() for i, (e, f) in enumerate(m.items())]
VALID = f"(type <> 'GENDER' OR upper({strip('text')}) IN ({listed(C.GENDERS)[1:-1]}) OR {strip('text')} IN ('Nam', 'Nữ'))"
OWN = """found AS (SELECT DISTINCT lang AS doc_type, label FROM tags JOIN documents USING (doc_id) WHERE lang IS NOT NULL),
own AS (SELECT doc_type, label, row_number() OVER (PARTITION BY doc_type ORDER BY label) - 1 AS id FROM found),
ids AS (SELECT * FROM own WHERE doc_type <> 'en' OR starts_with(label, 'B-'))"""
MAPPINGS = f"""{OWN}, layers AS (
  SELECT 0 AS layer, 'explicit' AS origin, * FROM ({values(P.EXPLICIT, 'doc_type, ord, etype, field')})
  UNION ALL SELECT 1, 'labels', doc_type, id, upper(replace(label[3:], '_VALUE', '')), label[3:] FROM ids WHERE regexp_matches(label, '^[BI]-.')
  UNION ALL SELECT 2, 'default', * FROM ({values(DEFAULTS, 'doc_type, ord, etype, field')})),
one AS (SELECT doc_type, layer, origin, etype, arg_min(field, ord) AS field FROM layers GROUP BY ALL),
mappings AS (SELECT doc_type, etype, field, origin FROM one QUALIFY layer = min(layer) OVER (PARTITION BY doc_type))"""
FIELDS = f"""schemas AS (SELECT DISTINCT doc_type, field FROM ({values(P.SCHEMAS, 'doc_type, ord, field')})),
fields AS (SELECT * FROM schemas UNION SELECT doc_type, field FROM mappings WHERE doc_type NOT IN (SELECT doc_type FROM schemas))"""


def records(docs: str, shown: str) -> str:
    """Of (doc_id, doc_type) the record as text, from ``ded``."""
    return f"""picks AS (SELECT doc_id, field, arg_max(text, ord) AS text, arg_max(ded.confidence, ord) AS confidence FROM ded JOIN {docs} d USING (doc_id) JOIN mappings m ON m.doc_type = d.doc_type AND m.etype = ded.type WHERE {VALID} GROUP BY ALL),
records AS (SELECT d.doc_id, d.doc_type, string_agg(f.field || '=' || {shown}, '|' ORDER BY f.field) AS record FROM {docs} d LEFT JOIN fields f ON f.doc_type = d.doc_type LEFT JOIN picks p ON p.doc_id = d.doc_id AND p.field = f.field GROUP BY ALL)"""


ORACLES = {
    "model_label_maps": f"""WITH {pseudo()}, {OWN}
SELECT doc_type, 'id2label' AS kind, id, label FROM ids UNION ALL SELECT doc_type, 'label2id', CASE WHEN doc_type = 'fr' THEN id + {P.SHIFT} ELSE id END, label FROM own""",
    "facade_schema": f"WITH {pseudo()}, {MAPPINGS} SELECT * FROM mappings",
    "facade_fields": f"WITH {pseudo()}, {MAPPINGS}, {FIELDS} SELECT * FROM fields",
    "extract_by_type": f"""WITH {entities()}, {CLEANED}, {MAPPINGS}, {FIELDS}, typed_docs AS (SELECT doc_id, lang AS doc_type FROM documents),
{records('typed_docs', "coalesce(p.text, '') || '@' || CAST(round(coalesce(p.confidence, 0) * 10000) AS BIGINT)")} SELECT * FROM records""",
    "extract_detected_type": f"""WITH {pseudo()}, {MAPPINGS}, {FIELDS}, documents_tidy AS (SELECT doc_id, {TIDY} AS text FROM (SELECT doc_id, text AS x FROM documents)),
{keyword_sql('doc_id', 'documents_tidy')}, best AS (SELECT doc_id, sum(score) AS total, arg_min(doc_type, struct_pack(a := -score, b := ord)) AS best, max(score) AS top FROM scores GROUP BY doc_id),
decision AS (SELECT doc_id, total, best, CASE WHEN total > 0 THEN round(top / total, 4) ELSE 0 END AS confidence FROM best),
detected AS (SELECT doc_id, CASE WHEN total > 0 AND confidence >= 0.25 THEN best END AS doc_type, confidence, CASE WHEN total > 0 THEN 'keyword' ELSE 'none' END AS method FROM decision),
ded AS (WITH {entities().replace('FROM documents', 'FROM documents_tidy')}, {CLEANED} SELECT * FROM ded),
{records('detected', "coalesce(p.text, '')")} SELECT r.*, confidence, method FROM records r JOIN detected USING (doc_id)""",
}
