"""The registered queries again, in DuckDB's SQL over the same tables."""

from __future__ import annotations

from ..functions import domain as D
from ..functions import text as X
from ..functions.text import SHORT_DATE, VIETNAMESE, WS, WS_NOT_NEWLINE
from ..operators import clean as C
from ..operators.detect import BOILERPLATE, WORD
from . import catalogue as Q

LONG_DATE = X.LONG_DATE.replace("(?iu)", "(?i)")


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, {q(rf'^{WS}+|{WS}+$')}, '', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(WS + '+')}), lambda w: w <> '')"


def capital(w: str) -> str:
    return f"CASE WHEN {w}[1:1] = 'ß' THEN 'Ss' ELSE upper({w}[1:1]) END || lower({w}[2:])"


def title(x: str) -> str:
    return rf"list_aggregate(list_transform(regexp_extract_all({x}, '\p{{L}}+|\P{{L}}+'), lambda w: {capital('w')}), 'string_agg', '')"


def uniform(*parts: str) -> str:
    key = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


def choose(values, u: str) -> str:
    return f"({listed(values)})[CAST(floor({u} * {len(values)}) AS INTEGER) + 1]"


TIDY = strip(rf"regexp_replace(regexp_replace(regexp_replace(nfc_normalize(x), {q(WS_NOT_NEWLINE + '+')}, ' ', 'g'), '[\x{{200B}}-\x{{200D}}\x{{FEFF}}]', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")
TOKENS = """
s AS (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS token, generate_subscripts(string_split(replace(text, chr(10), ' '), ' '), 1) AS p FROM documents),
o AS (SELECT doc_id, p, token, sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY p) - length(token) - 1 AS a FROM s),
tok AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS tok_idx, token, CAST(a AS BIGINT) AS start, CAST(a + length(token) AS BIGINT) AS "end" FROM o WHERE token <> '')
"""


def pseudo(labels=tuple(Q.LABELS)) -> str:
    label = choose(labels, uniform("42", "doc_id", "tok_idx", "'label'"))
    conf = f"floor({uniform('42', 'doc_id', 'tok_idx', q('conf'))} * 64) / 64"
    return f"{TOKENS}, tags AS (SELECT *, {label} AS label, {conf} AS conf FROM tok)"


def entities(value_only: bool = False) -> str:
    more = " OR label NOT LIKE '%\\_VALUE%' ESCAPE '\\'" if value_only else ""
    return f"""{pseudo()},
closed AS (SELECT *, (label = 'O' OR label NOT LIKE '%-%'{more}) AS closes, split_part(label, '-', 1) AS prefix, substr(label, instr(label, '-') + 1) AS name FROM tags),
typed AS (SELECT *, CASE WHEN NOT closes THEN upper(replace(name, '_VALUE', '')) END AS type FROM closed WHERE closes OR prefix IN ('B', 'I')),
marked AS (SELECT *, CASE WHEN type IS NOT NULL AND (prefix = 'B' OR type IS DISTINCT FROM lag(type) OVER (PARTITION BY doc_id ORDER BY tok_idx)) THEN 1 ELSE 0 END AS opens FROM typed),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY tok_idx) AS ord FROM marked),
ent AS (SELECT doc_id, CAST(ord AS BIGINT) AS ord, arg_min(type, tok_idx) AS type, string_agg(token, ' ' ORDER BY tok_idx) AS text, min(start) AS start, max("end") AS "end", 'B-' || arg_min(name, tok_idx) AS label, round(avg(conf), 4) AS confidence
  FROM numbered WHERE type IS NOT NULL GROUP BY doc_id, ord)"""


def window_rows(step: int) -> str:
    return f"""n AS (SELECT doc_id, CAST(len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda t: t <> '')) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, n, unnest(range(0, CAST(1 + greatest(ceil((n - 254) / {step}.0), 0) AS BIGINT))) AS win FROM n WHERE n > 0),
spans AS (SELECT doc_id, win, win * {step} AS start, least(win * {step} + 254, n) AS "end" FROM w)"""


PREDICTED = f"""{window_rows(128)}, pos AS (SELECT doc_id, win, unnest(range(start, "end")) AS pos FROM spans),
pred AS (SELECT *, {choose(("O", "B-name", "I-name"), uniform('7', 'doc_id', 'win', 'pos'))} AS label, floor({uniform('8', 'doc_id', 'win', 'pos')} * 64) / 64 AS conf FROM pos),
means AS (SELECT doc_id, pos, label, avg(conf) AS conf, min(win) AS win FROM pred GROUP BY ALL),
merged AS (SELECT doc_id, pos, label, conf FROM means QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY conf DESC, win) = 1)"""

LOCATED = "spans AS (SELECT doc_id, item_id, CAST(instr(d.text, b.text) - 1 AS BIGINT) AS start, CAST(instr(d.text, b.text) - 1 + length(b.text) AS BIGINT) AS \"end\" FROM documents d, benchmark b WHERE b.text <> '' AND contains(d.text, b.text))"


def tagged(ranked: bool) -> str:
    label = "CASE WHEN item_id % 3 = 0 THEN 'alpha' ELSE 'beta' END"
    role = "CASE WHEN item_id % 2 = 0 THEN 'VALUE' ELSE 'LABEL' END"
    name, rank = (f"{label} || '_' || {role}", f"CASE WHEN {role} = 'VALUE' THEN 0 ELSE 1 END") if ranked else (label, "0")
    # the overlap join meets only tokens of documents that hold a span
    return f"""WITH {LOCATED.replace("spans AS (", "spans AS MATERIALIZED (", 1)}, {TOKENS.replace("tok AS (", "tok AS MATERIALIZED (", 1)},
ents AS (SELECT *, {name} AS label, {rank} AS r, row_number() OVER (PARTITION BY doc_id ORDER BY start, item_id) AS ord FROM spans),
near AS MATERIALIZED (SELECT * FROM tok WHERE doc_id IN (SELECT doc_id FROM spans)),
hits AS MATERIALIZED (SELECT x.doc_id, x.tok_idx, x.label, x.ord, row_number() OVER (PARTITION BY x.doc_id, x.tok_idx ORDER BY x.r, x.start, x.ord) AS place FROM
  (SELECT t.doc_id, t.tok_idx, t.start AS a, t."end" AS b, e.label, e.ord, e.r, e.start, e."end" FROM near t JOIN ents e ON t.doc_id = e.doc_id) x WHERE x.b > x.start AND x.a < x."end"),
firsts AS MATERIALIZED (SELECT doc_id, tok_idx, label, min(tok_idx) OVER (PARTITION BY doc_id, ord) AS first_idx FROM hits WHERE place = 1)
SELECT t.doc_id, t.tok_idx, t.token, coalesce(CASE WHEN t.tok_idx = f.first_idx THEN 'B-' ELSE 'I-' END || f.label, 'O') AS label
FROM tok t LEFT JOIN firsts f ON t.doc_id = f.doc_id AND t.tok_idx = f.tok_idx"""


def split_sql() -> str:
    return """r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents),
split AS (SELECT doc_id, CASE WHEN r <= floor(n * 0.8) THEN 'train' WHEN r <= floor(n * 0.8) + floor(n * 0.1) THEN 'valid' ELSE 'test' END AS split FROM r)"""


def trim_bleed(etype: str, x: str) -> str:
    x = strip(x)
    for p in C.LEADING_LABELS:
        x = f"regexp_replace({x}, {q(p.replace('(?iu)', '(?i)'))}, '', 'g')"
    address = "ADDRESS" in etype
    if address:
        # RE2 has no lookahead: what follows the marker's value is kept as a group
        pattern = C.CLASS_VALUE.replace("(?iu)", "(?i)").replace(r"(?![\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)")
        x = rf"trim(regexp_replace(regexp_replace({x}, {q(pattern)}, ' \2', 'g'), {q(WS + '{2,}')}, ' ', 'g'), ' ,.;:-')"
    if not any(k in etype for k in C.FREE_TEXT):
        return strip(x)
    markers = C.CUT_MARKERS if address else C.CLASS_MARKERS + C.CUT_MARKERS
    first = f"list_min(list_filter(list_transform({listed(markers)}, lambda m: instr(lower(z), m)), lambda p: p > 1))"
    return strip(f"(SELECT CASE WHEN {first} IS NOT NULL THEN trim(substr(z, 1, CAST({first} AS BIGINT) - 1), ' ,.;:-') ELSE z END FROM (SELECT {x} AS z))")


CLEANED = f"""
trimmed AS (SELECT *, CASE type WHEN 'ADDRESS' THEN {trim_bleed('ADDRESS', 'text')} WHEN 'NOTES' THEN {trim_bleed('NOTES', 'text')} ELSE {trim_bleed('NAME', 'text')} END AS t FROM ent),
firsts AS (SELECT doc_id, type, min(ord) AS ord, arg_min(start, ord) AS start, arg_min("end", ord) AS e1, arg_max("end", ord) AS e2, arg_min(confidence, ord) AS confidence, arg_min(t, ord) AS h, list(t ORDER BY ord) AS all_t FROM trimmed GROUP BY doc_id, type),
ded AS (SELECT doc_id, ord, type, CASE WHEN type = 'NAME' THEN list_aggregate(list_transform({words('h')}, lambda w: {capital('w')}), 'string_agg', ' ') WHEN type IN ('ADDRESS', 'NOTES') THEN list_aggregate(all_t, 'string_agg', ', ') ELSE h END AS text,
  start, CASE WHEN type IN ('ADDRESS', 'NOTES') THEN e2 ELSE e1 END AS "end", confidence FROM firsts)"""


def valid_sql(policy: str) -> str:
    types = ", ".join(f"({i}, {q(t)})" for i, t in enumerate(Q.TYPES))
    date = r"[0-9]{2}/[0-9]{2}/[0-9]{4}"
    some = f"regexp_matches(bare, '{date}')" if policy == "sdk" else f"regexp_matches(bare, '^{date}$')"
    number = "regexp_matches(tight, '^[0-9]{9,13}$')" if policy == "sdk" else "regexp_matches(bare, '^([0-9]{9}|[0-9]{12})$')"
    genders = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in C.GENDERS.items())
    return rf"""WITH g AS (SELECT i, c_custkey AS j, type, CASE WHEN c_custkey % 5 = 4 THEN c_name ELSE ({listed(Q.VALUES)})[c_custkey % {len(Q.VALUES)} + 1] END AS value FROM customer, (VALUES {types}) v(i, type)),
m AS (SELECT *, {strip('value')} AS bare, regexp_replace(value, {q(WS)}, '', 'g') AS tight, len({words('value')}) AS n FROM g)
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, CASE type
  WHEN 'PATIENT_DOB' THEN regexp_matches(bare, '^({date}|[0-9]{{4}})$') WHEN 'DOB' THEN {some} WHEN 'DATE_OF_EXPIRY' THEN {some}
  WHEN 'ADMISSION_DATE' THEN regexp_matches(bare, '[0-9]{{1,2}}[^\n]*[0-9]{{4}}') WHEN 'GENDER' THEN CASE upper(bare) {genders} ELSE bare END IN ('Nam', 'Nữ')
  WHEN 'PATIENT_ETHNICITY' THEN n BETWEEN 1 AND 3 WHEN 'PATIENT_NAME' THEN n BETWEEN 2 AND 7 AND NOT regexp_matches(value, '\p{{Nd}}')
  WHEN 'FULL_NAME' THEN regexp_matches(bare, {q(rf'(?i)^([{C.NAME_LETTERS}]|{WS})+$')}) AND n BETWEEN 2 AND 6 WHEN 'ID_NUMBER' THEN {number}
  WHEN 'BHXH_CODE' THEN length(tight) >= 8 WHEN 'MEDICAL_CODE' THEN regexp_matches(value, '\p{{Nd}}') WHEN 'DIAGNOSIS' THEN length(bare) >= 5 ELSE true END AS valid FROM m"""


def corpus_sql() -> str:
    return rf"""item AS (SELECT 't' || (item_id % 7) AS doc_type, item_id, regexp_extract_all(lower(text), {q(WORD)}) AS w FROM benchmark),
corpus AS (SELECT doc_type, flatten(list(w ORDER BY item_id)) AS w FROM item GROUP BY doc_type),
grams AS (SELECT doc_type, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM corpus),
counts AS (SELECT doc_type, term, count(*) AS n FROM grams GROUP BY ALL),
top AS (SELECT term, count(*) AS df, sum(n) AS a FROM counts GROUP BY term ORDER BY a DESC, term LIMIT 8000),
idfs AS (SELECT term, ln((1 + (SELECT count(*) FROM corpus)) / (1 + df)) + 1 AS idf FROM top),
raw AS (SELECT doc_type, term, (1 + ln(n)) * idf AS r, idf FROM counts JOIN idfs USING (term)),
idx AS (SELECT doc_type, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_type)) AS weight, idf FROM raw)"""


def lang_corpus_sql() -> str:
    return rf"""text AS (SELECT lang AS doc_type, regexp_extract_all(lower(text), {q(WORD)}) AS w FROM documents WHERE lang IS NOT NULL),
grams AS (SELECT doc_type, unnest(list_concat(w, list_transform(list_zip(w, w[2:], true), lambda x: x[1] || ' ' || x[2]))) AS term FROM text),
counts AS (SELECT doc_type, term, count(*) AS n FROM grams GROUP BY ALL),
top AS (SELECT term, count(*) AS df, sum(n) AS a FROM counts GROUP BY term ORDER BY a DESC, term LIMIT 8000),
idfs AS (SELECT term, ln((1 + (SELECT count(DISTINCT doc_type) FROM text)) / (1 + df)) + 1 AS idf FROM top),
raw AS (SELECT doc_type, term, (1 + ln(n)) * idf AS r, idf FROM counts JOIN idfs USING (term)),
idx AS (SELECT doc_type, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_type)) AS weight, idf FROM raw)"""


TURNS = "turns AS (SELECT conv_id || '-' || turn AS key, text FROM conversations)"
TURN_SCORES = r"""qw AS (SELECT key, unnest(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '')) AS term FROM turns),
qn AS (SELECT key, term, (1 + ln(count(*))) * any_value(idf) AS v FROM qw JOIN idfs USING (term) GROUP BY key, term),
norms AS (SELECT key, sqrt(sum(v * v)) AS norm FROM qn GROUP BY key),
cosines AS (SELECT key, doc_type, sum(v * weight) / any_value(norm) AS score FROM qn JOIN idx USING (term) JOIN norms USING (key) GROUP BY key, doc_type)"""


def keyword_sql(key: str, source: str) -> str:
    from ..functions.text import keyword_form_of

    scores = []
    for i, (t, kinds) in enumerate(Q.RULES.items()):
        terms = [f"CASE WHEN contains(norm, {q(keyword_form_of(w))}) THEN {weight} ELSE 0 END" for kind, weight in (("strong", "3.0::DOUBLE"), ("weak", "1.0::DOUBLE"), ("exclude", "-10.0::DOUBLE")) for w in kinds[kind]]
        scores.append(f"SELECT {key}, {i} AS ord, '{t}' AS doc_type, greatest({' + '.join(terms)}, 0) AS score FROM normed")
    return f"normed AS (SELECT {key}, trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')) AS norm FROM {source}), scores AS ({' UNION ALL '.join(scores)})"


def templates_sql() -> str:
    bodies = " ".join(f"WHEN {i} THEN {q(b)}" for i, (_, _, b) in enumerate(Q.TEMPLATE_TEXTS))
    return f"t AS (SELECT lower(p_type) AS doc_type, p_partkey AS idx, upper(p_name) || chr(10) || CASE p_partkey % {len(Q.TEMPLATE_TEXTS)} {bodies} END AS body FROM part)"


def rules_sql() -> str:
    return rf"""WITH {templates_sql()},
l AS (SELECT doc_type, idx, generate_subscripts(string_split(body, chr(10)), 1) AS line_no, unnest(string_split(body, chr(10))) AS raw FROM t),
k AS (SELECT doc_type, idx, line_no, contains(raw, '{{{{') AS has, {strip('raw')} AS line FROM l),
kw AS (SELECT doc_type, idx, line_no, CASE WHEN has THEN 'weak' ELSE 'strong' END AS kind, CASE WHEN has THEN lower({strip("regexp_replace(split_part(line, '{{', 1), '[\\s:/\\-]+$', '')")}) ELSE lower(line) END AS keyword FROM k),
ok AS (SELECT * FROM kw WHERE CASE WHEN kind = 'weak' THEN length(keyword) >= 3 ELSE length(keyword) >= 4 AND keyword NOT IN ({listed(BOILERPLATE)[1:-1]}) END),
firsts AS (SELECT doc_type, kind, keyword, min(idx * 1000 + line_no) AS f FROM ok GROUP BY ALL),
own AS (SELECT doc_type, kind, keyword, row_number() OVER (PARTITION BY doc_type, kind ORDER BY f, keyword) - 1 AS ord FROM firsts)
SELECT * FROM own UNION ALL
SELECT a.doc_type, 'exclude', b.keyword, row_number() OVER (PARTITION BY a.doc_type ORDER BY b.doc_type, b.ord) - 1 FROM (SELECT DISTINCT doc_type FROM own) a JOIN own b ON a.doc_type <> b.doc_type AND b.kind = 'strong'"""


def noise_sql() -> str:
    u = lambda s: uniform("42", "item_id", "i", q(s))
    alike = " ".join(f"WHEN {q(c)} THEN {choose(list(v), u('which'))}" for c, v in D.CONFUSABLE.items())
    bare = f"translate(c, {q(D.MARKED)}, {q(D.UNMARKED)})"
    spaced = f"CASE WHEN c = ' ' AND {u('space')} < 0.05 THEN CASE WHEN {u('space2')} < 0.6 THEN '  ' ELSE '' END ELSE c END"
    return f"""WITH chars AS (SELECT item_id, length(text) AS n, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) - 1 AS i FROM benchmark),
r AS (SELECT *, CASE WHEN i >= 4 AND i < least(12, n) THEN c WHEN c = chr(10) AND {u('line')} < 0.12 THEN CASE WHEN {u('line2')} < 0.5 THEN '' ELSE ' ' END
  WHEN c IN ({listed(D.CONFUSABLE)[1:-1]}) AND {u('alike')} < 0.15 THEN CASE c {alike} END WHEN {bare} <> c AND {u('mark')} < 0.1 THEN {bare}
  WHEN c <> chr(10) AND {u('drop')} < 0.05 THEN '' WHEN {u('insert')} < 0.03 THEN {choose(list('abcdefghijklmnopqrstuvwxyz0123456789'), u('letter'))} || ({spaced}) ELSE {spaced} END AS x FROM chars)
SELECT item_id, string_agg(x, '' ORDER BY i) AS text, CAST(sum(CASE WHEN i < 4 THEN length(x) ELSE 0 END) AS BIGINT) AS start, CAST(sum(CASE WHEN i < 12 THEN length(x) ELSE 0 END) AS BIGINT) AS "end" FROM r GROUP BY item_id"""


def name_sql(seed: str, names, slot: str) -> str:
    return f"{choose(D.SURNAMES, uniform(q(seed), 'row_id', q(slot + '.s')))} || ' ' || {choose(names, uniform(q(seed), 'row_id', q(slot + '.n')))}"


class Slots:
    """SQL of the draws of record ``row_id`` of a type."""

    def __init__(self, doc_type: str) -> None:
        self.seed = f"42|{doc_type}"

    def u(self, s: str) -> str:
        return uniform(q(self.seed), "row_id", q(s))

    def pick(self, values, s: str) -> str:
        return choose(list(values), self.u(s))

    def whole(self, low: int, high: int, s: str) -> str:
        return f"CAST({low} + floor({self.u(s)} * {high - low + 1}) AS BIGINT)"

    def text(self, low: int, high: int, s: str) -> str:
        return f"CAST({self.whole(low, high, s)} AS VARCHAR)"

    def digits(self, n: int, s: str) -> str:
        return " || ".join(self.text(0, 9, f"{s}{i}") for i in range(n))

    def day(self, first: str, last: str | int, s: str) -> str:
        span = last if isinstance(last, int) else f"(DATE '{last}' - DATE '{first}')"
        return f"(DATE '{first}' + CAST(floor({self.u(s)} * ({span} + 1)) AS INTEGER))"

    def name(self, names, s: str) -> str:
        return name_sql(self.seed, names, s)

    def city(self, s: str) -> str:
        return f"{self.pick(D.DISTRICTS, s + '.d')} || ', ' || {self.pick(D.PROVINCES, s + '.p')}"

    def address(self, s: str) -> str:
        tail = f"{self.pick(D.WARDS, s + '.w')} || ', ' || {self.city(s)}"
        street = self.pick(D.STREETS, s + ".st")
        w = lambda low, high, x: self.whole(low, high, f"{s}.{x}")
        return f"""CASE {w(0, 3, 'style')} WHEN 0 THEN 'Thôn ' || {self.pick(D.HAMLETS, s + '.h')} || ', ' || {tail} WHEN 1 THEN {w(1, 300, 'no')} || ' ' || {street} || ', ' || {tail} WHEN 2 THEN {tail}
      ELSE {w(1, 999, 'a')} || '/' || {w(1, 99, 'b')} || '/' || {w(1, 30, 'c')} || ' ' || {street} || ', KP' || {w(1, 5, 'kp')} || ', ' || {tail} END"""


def dmy(day: str) -> str:
    return f"strftime({day}, '%d/%m/%Y')"


def records_sql(fields: dict[str, str]) -> str:
    return "SELECT row_id, " + ", ".join(f"{v} AS {n}" for n, v in fields.items()) + " FROM (SELECT c_custkey AS row_id FROM customer)"


def gen_gplx_sql() -> str:
    d = Slots("gplx")
    issue = d.day("2015-01-01", 3000, "issue")
    return records_sql({"id_number": d.digits(12, "id"), "full_name": f"upper({d.name(D.DRIVER_NAMES, 'name')})", "date_of_birth": dmy(d.day("1970-01-01", "2005-12-31", "dob")), "nationality": "'Việt Nam'", "address": d.address("home"), "issue_date": dmy(issue), "expiry_date": dmy(f"({issue} + 3650)"), "class": d.pick(D.LICENCE_CLASSES, "class")})


def gen_cccd_sql() -> str:
    d = Slots("cccd")
    return records_sql({"id_number": d.digits(12, "id"), "full_name": f"upper({d.name(D.PERSON_NAMES, 'name')})", "date_of_birth": dmy(d.day("1960-01-01", "2005-12-31", "dob")), "gender": d.pick(D.GENDERS, "gender"), "nationality": q(D.NATIONALITY), "place_of_origin": d.city("origin"),
                        "place_of_residence": d.address("home"), "date_of_expiry": dmy(f"({d.day('2016-01-01', 3000, 'issue')} + 3650)")})


def gen_birth_sql() -> str:
    d = Slots("giay_khai_sinh")
    born = d.day("2010-01-01", 5000, "dob")
    return records_sql({"id_number": d.digits(12, "id"), "full_name": f"upper({d.name(D.CHILD_NAMES, 'name')})", "gender": d.pick(D.GENDERS, "gender"), "date_of_birth": dmy(born), "dob_text": "'Một ngày nào đó'", "place_of_birth": d.city("birth"), "ethnicity": "'Kinh'", "nationality": q(D.NATIONALITY),
                        "father_name": f"upper({d.name(D.CHILD_NAMES, 'father')})", "mother_name": f"upper({d.name(D.CHILD_NAMES, 'mother')})", "registration_place": d.city("office"), "registration_date": dmy(f"({born} + CAST({d.whole(1, 30, 'wait')} AS INTEGER))")})


def gen_vehicle_sql() -> str:
    d = Slots("vehicle_registration")
    day = d.day("2015-01-01", "2025-12-31", "day")
    series = f"{d.pick(D.PLATE_PROVINCES, 'plate.p')} || {d.pick(D.PLATE_LETTERS, 'plate.l')}"
    plate = f"CASE WHEN {d.u('plate')} < 0.5 THEN {series} || {d.text(0, 9, 'plate.d')} || ' ' || {d.text(10000, 99999, 'plate.n')} ELSE {series} || '-' || {d.text(100, 999, 'plate.a')} || '.' || {d.text(10, 99, 'plate.b')} END"
    return records_sql({"owner_name": f"upper({d.name(D.DRIVER_NAMES, 'name')})", "owner_address": d.address("home"), "plate_number": plate, "id_number": d.digits(8, "id"), "vehicle_type": d.pick(D.VEHICLE_TYPES, "type"), "brand": d.pick(D.BRANDS, "brand"), "model_code": d.pick(D.MODELS, "model"),
                        "engine_number": f"{d.pick(D.ENGINE_PREFIXES, 'engine')} || {d.digits(7, 'engine')}", "chassis_number": f"{d.pick(D.CHASSIS_PREFIXES, 'chassis')} || {d.digits(10, 'chassis')}", "color": d.pick(D.COLORS, "color"), "manufacture_year": d.text(2010, 2024, "year"),
                        "manufacture_country": d.pick(D.COUNTRIES, "country"), "registration_date": dmy(day), "expiry_date": dmy(f"({day} + 730)")})


def gen_discharge_sql() -> str:
    d = Slots("giay_ra_vien")
    name, case, admit = d.name(D.PATIENT_NAMES, "name"), d.u("case"), d.day("2020-01-01", 1500, "admit")
    born = d.day("1940-01-01", "2020-12-31", "dob")
    one, two = (f"{d.pick([b for _, b in D.DIAGNOSES], s)} || ' (' || {d.pick([a for a, _ in D.DIAGNOSES], s)} || ')'" for s in ("diagnosis", "diagnosis2"))

    def when(day: str, s: str) -> str:
        hour, minute = d.text(6, 22, f"{s}.h"), f"lpad({d.text(0, 59, f'{s}.m')}, 2, '0')"
        long, short = f"strftime({day}, 'ngày %-d tháng %-m năm %Y')", f"strftime({day}, '%-d/%-m/%Y')"
        return f"CASE {d.whole(0, 3, 'format')} WHEN 0 THEN {hour} || ' giờ ' || {minute} || ' phút, ' || {long} WHEN 1 THEN {hour} || ' giờ ' || {minute} || ' ' || {long} WHEN 2 THEN {short} ELSE {long} END"

    groups = [f"substr({d.digits(5, f'bhxh{i}')}, 1, {d.whole(3, 5, f'bhxh.len{i}')})" for i in range(3)]
    insurance = f"CASE {d.whole(0, 2, 'bhxh')} WHEN 0 THEN 'GD' || {d.digits(13, 'bhxh')} WHEN 1 THEN 'HS ' || {groups[0]} || ' ' || {groups[1]} || ' ' || {groups[2]} ELSE 'GD ' || {d.text(1, 9, 'bhxh.a')} || ' ' || {d.text(10, 99, 'bhxh.b')} || ' ' || {d.digits(11, 'bhxh.c')} END"
    return records_sql({"hospital_name": d.pick([a for a, _ in D.HOSPITALS], "hospital"), "dept_mgmt": d.pick([b for _, b in D.HOSPITALS], "hospital"), "department": d.pick(D.DEPARTMENTS, "department"), "medical_code": f"{d.text(20, 24, 'med.y')} || '.' || lpad({d.text(1000, 99999, 'med.n')}, 6, '0')",
                        "patient_name": f"CASE WHEN {case} < 0.4 THEN upper({name}) WHEN {case} < 0.7 THEN {name} ELSE lower({name}) END", "patient_dob": f"CASE WHEN {d.u('year only')} < 0.3 THEN strftime({born}, '%Y') ELSE {dmy(born)} END",
                        "patient_gender": d.pick(D.GENDERS, "gender"), "patient_ethnicity": d.pick(D.ETHNICITIES, "ethnicity"), "patient_occupation": d.pick(D.OCCUPATIONS, "occupation"), "patient_address": d.address("home"), "bhxh_code": insurance,
                        "admission_date": when(admit, "in"), "discharge_date": when(f"({admit} + CAST({d.whole(1, 20, 'stay')} AS INTEGER))", "out"), "diagnosis": f"CASE WHEN {d.u('two')} < 0.4 THEN {one} || '; ' || {two} ELSE {one} END", "treatment_method": d.pick(D.TREATMENTS, "treatment"), "notes": d.pick(D.NOTES, "notes")})


def extract_sql() -> str:
    from .extract import GENERAL_MAPPING, GENERAL_RULES

    label = "CASE " + " ".join(f"WHEN regexp_matches(token, {q(p)}) THEN {q(n.upper())}" for p, n in GENERAL_RULES) + " END"
    value = f"(SELECT {trim_bleed('NUMBER', 'x')} FROM (SELECT token AS x))"
    fields = ", ".join(f"coalesce(max(v) FILTER (type = '{t}'" + (rf" AND regexp_matches(regexp_replace(v, {q(WS)}, '', 'g'), '^[0-9]{{9,13}}$')" if t == "ID_NUMBER" else "") + f"), '') AS {f}" for t, f in GENERAL_MAPPING.items())
    return f"""WITH documents_tidy AS (SELECT doc_id, {TIDY} AS text FROM (SELECT doc_id, text AS x FROM documents)), {TOKENS.replace('FROM documents', 'FROM documents_tidy')},
named AS (SELECT doc_id, tok_idx, token, {label} AS type FROM tok),
firsts AS (SELECT doc_id, type, token FROM named WHERE type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, type ORDER BY tok_idx) = 1),
ent AS (SELECT doc_id, type, {value} AS v FROM firsts),
fields AS (SELECT d.doc_id, {fields} FROM documents d LEFT JOIN ent USING (doc_id) GROUP BY d.doc_id),
{keyword_sql('doc_id', 'documents_tidy')}, best AS (SELECT doc_id, sum(score) AS total, arg_min(doc_type, struct_pack(a := -score, b := ord)) AS best, max(score) AS top FROM scores GROUP BY doc_id),
decision AS (SELECT *, CASE WHEN total > 0 THEN round(top / total, 4) ELSE 0 END AS confidence FROM best)
SELECT f.*, CASE WHEN total > 0 AND confidence >= 0.25 THEN best END AS doc_type, confidence, CASE WHEN total > 0 THEN 'keyword' ELSE 'none' END AS method FROM fields f JOIN decision USING (doc_id)"""


def padded(x: str, pattern: str) -> str:
    p = q(pattern.replace(r"\z", "$"))
    return f"lpad(regexp_extract({x}, {p}, 1), 2, '0') || '/' || lpad(regexp_extract({x}, {p}, 2), 2, '0') || '/' || regexp_extract({x}, {p}, 3)"


def date_sql(x: str) -> str:
    x = strip(x)
    return f"CASE WHEN regexp_matches({x}, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$') THEN {x} WHEN regexp_matches({x}, {q(LONG_DATE)}) THEN {padded(x, LONG_DATE)} WHEN regexp_matches({x}, {q(SHORT_DATE.replace(chr(92) + 'z', '$'))}) THEN {padded(x, SHORT_DATE)} ELSE {x} END"


def normal_name(x: str) -> str:
    x = strip(x)
    return f"CASE WHEN {x} = upper({x}) OR {x} = lower({x}) THEN {title(x)} ELSE {x} END"


GATE = """best AS (SELECT user_id, max(CASE WHEN event_type <> 'click' THEN round(value / 100, 4) END) AS best FROM events GROUP BY user_id),
gate AS (SELECT user_id, best, CASE WHEN user_id % 11 = 0 THEN 'generate_failed' WHEN user_id % 7 = 0 THEN 'train_failed' WHEN coalesce(best, 0) < 0.2 THEN 'low_f1' WHEN user_id % 5 = 0 THEN 'no_hf_token' WHEN user_id % 3 = 0 THEN 'publish_failed' ELSE 'published' END AS status FROM best)"""
LABEL_IDS = "ids AS (SELECT row_number() OVER (ORDER BY label <> 'O', label) - 1 AS id, label FROM (SELECT DISTINCT label FROM tags UNION SELECT 'O'))"
TYPE_NAME = "lower(replace(n_name, ' ', '_'))"
ITEM_SPACED = title("replace(t, '_', ' ')")


def score_sql() -> str:
    def chunk(name: str, source: str) -> str:
        return f"""{name}m AS (SELECT doc_id, tok_idx, CASE WHEN label <> 'O' THEN substr(label, 3) END AS type, label LIKE 'B-%' AS b FROM {source}),
{name}n AS (SELECT *, sum(CASE WHEN type IS NOT NULL AND (b OR type IS DISTINCT FROM p) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY tok_idx) AS n FROM (SELECT *, lag(type) OVER (PARTITION BY doc_id ORDER BY tok_idx) AS p FROM {name}m)),
{name} AS (SELECT doc_id, any_value(type) AS type, min(tok_idx) AS s, max(tok_idx) AS e FROM {name}n WHERE type IS NOT NULL GROUP BY doc_id, n)"""

    return f"""WITH {pseudo(tuple(Q.LABELS[:9]))}, guess AS (SELECT doc_id, tok_idx, CASE WHEN {uniform('3', 'doc_id', 'tok_idx')} < 0.1 THEN 'O' ELSE label END AS label FROM tags),
{chunk('gold', 'tags')}, {chunk('pred', 'guess')},
j AS (SELECT coalesce(g.type, p.type) AS type, g.type IS NOT NULL AS is_g, p.type IS NOT NULL AS is_p FROM gold g FULL JOIN pred p ON g.doc_id = p.doc_id AND g.type = p.type AND g.s = p.s AND g.e = p.e),
c AS (SELECT type, count(*) FILTER (is_g AND is_p) AS tp, count(*) FILTER (is_p) AS n_pred, count(*) FILTER (is_g) AS n_gold FROM j GROUP BY GROUPING SETS ((type), ()))
SELECT type, tp, n_pred, n_gold, round(CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END, 4) AS precision, round(CASE WHEN n_gold > 0 THEN tp / n_gold ELSE 0 END, 4) AS recall, round(CASE WHEN n_pred + n_gold > 0 THEN 2 * tp / (n_pred + n_gold) ELSE 0 END, 4) AS f1 FROM c"""


DAY = {"short": "strftime(o_orderdate, '%-d/%-m/%Y')", "long": "'  x ngày ' || strftime(o_orderdate, '%-d') || ' tháng ' || strftime(o_orderdate, '%-m') || '  năm ' || strftime(o_orderdate, '%Y')", "padded": "strftime(o_orderdate, '%d/%m/%Y')", "iso": "strftime(o_orderdate, '%Y-%m-%d')"}

BLEED = {"PATIENT_ADDRESS": "'Nơi cư trú/Address:  ' || c_name || ' Hạng/Class:, B2  X. ' || c_mktsegment || ' Ngày cấp 3'", "NOTES": "'Chẩn đoán: ' || c_name || ' ;- HỌ TÊN ' || c_mktsegment", "FULL_NAME": "' họ tên ' || c_name", "DIAGNOSIS": "'Gender ' || c_name || ' , class: x'"}

ORACLES = {
    "token_offsets": f'WITH {TOKENS} SELECT doc_id, tok_idx, token, start, "end" FROM tok',
    "token_stats": "WITH n AS (SELECT *, len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda t: t <> '')) AS k FROM documents) SELECT source, lang, count(*) AS n_docs, CAST(sum(k) AS BIGINT) AS n_tokens, max(k) AS most_tokens, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM n GROUP BY source, lang",
    "clean_text": f"SELECT doc_id, {TIDY} AS text FROM (SELECT doc_id, text AS x FROM documents)",
    "clean_pages": f"SELECT page_id, {TIDY} AS text FROM (SELECT page_id, html AS x FROM pages)",
    "segment_lines": f"WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda s: {strip('s')}), lambda s: s <> '') AS l FROM documents) SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line FROM l",
    "normalize_text": "SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')) AS norm FROM documents",
    "vietnamese_flag": f"SELECT lang, count(*) AS n, count(*) FILTER (regexp_matches(text, {q(f'[{VIETNAMESE}{VIETNAMESE.upper()}]')})) AS n_flagged FROM documents GROUP BY lang",
    "normalize_name": f"SELECT p_partkey, {normal_name('p_name')} AS name, {normal_name('upper(p_type)')} AS type FROM part",
    "normalize_date": "SELECT o_orderkey, " + ", ".join(f'{date_sql(x)} AS "{n}"' for n, x in DAY.items()) + " FROM orders",
    "model_names": f"SELECT n_nationkey, {ITEM_SPACED} AS name, 'owner/phobert-' || t || '-ner' AS repo_id, t AS doc_type FROM (SELECT n_nationkey, {TYPE_NAME} AS t FROM nation)",
    "span_locate": f'WITH {LOCATED} SELECT doc_id, item_id, start, "end" FROM spans',
    "bio_assign": tagged(False),
    "bio_role_ranked": tagged(True),
    "label_list": f"WITH {pseudo()}, {LABEL_IDS} SELECT id, label FROM ids",
    "label_table": f"WITH {pseudo()}, {LABEL_IDS} SELECT label, CASE WHEN label LIKE 'B-%' THEN 'Begin' WHEN label LIKE 'I-%' THEN 'Inside' ELSE 'Outside' END AS kind, CASE WHEN label <> 'O' THEN substr(label, 3) END AS field FROM ids",
    "split_train_test": f"WITH {split_sql()} SELECT * FROM split",
    "dataset_card_stats": f"WITH {split_sql()} SELECT split, count(*) AS n, CAST(sum(len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda t: t <> ''))) AS BIGINT) AS n_tokens FROM split JOIN documents USING (doc_id) GROUP BY split",
    "oversample_union": "SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM labels, range(3)) GROUP BY doc_id",
    "window_spans_infer": f'WITH {window_rows(128)} SELECT doc_id, win, start, "end" FROM spans',
    "window_spans_train": f'WITH {window_rows(126)} SELECT doc_id, win, start, "end" FROM spans',
    "label_align": """WITH w AS (SELECT doc_id, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda t: t <> '') AS w FROM documents),
l AS (SELECT doc_id, flatten(list_transform(w, lambda t: list_concat([CASE WHEN regexp_matches(t[1:1], '[A-Z]') THEN 1 ELSE 0 END], list_transform(range(1, CAST(ceil(length(t) / 3.0) AS BIGINT)), lambda i: -100)))) AS l FROM w)
SELECT doc_id, len(l) AS n, len(list_filter(l, lambda x: x = 1)) AS n_names, len(list_filter(l, lambda x: x = -100)) AS n_ignored, sha256(array_to_string(l, ',')) AS labels_sha256 FROM l""",
    "overlap_merge": f"WITH {PREDICTED} SELECT doc_id, pos, label, round(conf, 4) AS conf FROM merged",
    "word_from_subword": f"WITH {PREDICTED} SELECT doc_id, pos // 3 AS word, arg_min(label, pos) AS label, round(avg(conf), 4) AS conf FROM merged GROUP BY doc_id, pos // 3",
    "bio_decode": f"WITH {entities()} SELECT * FROM ent",
    "bio_decode_values": f"WITH {entities(True)} SELECT * FROM ent",
    "bleed_trim": "SELECT c_custkey, " + ", ".join(f"{trim_bleed(t, v)} AS {t.lower()}" for t, v in BLEED.items()) + " FROM customer",
    "dedup_entities": f"WITH {entities()}, {CLEANED} SELECT * FROM ded",
    "first_valid_entities": f'WITH {entities()} SELECT doc_id, ord, type, text, start, "end", confidence FROM ent WHERE type <> \'GENDER\' OR upper({strip("text")}) IN ({listed(C.GENDERS)[1:-1]}) OR {strip("text")} IN (\'Nam\', \'Nữ\') QUALIFY row_number() OVER (PARTITION BY doc_id, type ORDER BY ord) = 1',
    "validate_entities": valid_sql("sdk"),
    "validate_entities_repo": valid_sql("repo"),
    "schema_map": f"WITH {entities()}, {CLEANED} SELECT d.doc_id, " + ", ".join(f"coalesce(max(text) FILTER (type = '{t}'), '') AS {f}" for t, f in Q.TYPE_FIELDS.items()) + " FROM (SELECT doc_id FROM documents) d LEFT JOIN ded USING (doc_id) GROUP BY d.doc_id",
    "schema_map_valid": f"WITH {entities()}, {CLEANED} SELECT d.doc_id, " + ", ".join(f"coalesce(max(text) FILTER (type = '{t}'" + (f" AND (upper({strip('text')}) IN ({listed(C.GENDERS)[1:-1]}) OR {strip('text')} IN ('Nam', 'Nữ'))" if t == "GENDER" else "") + f"), '') AS {f}" for t, f in Q.TYPE_FIELDS.items()) + " FROM (SELECT doc_id FROM documents) d LEFT JOIN ded USING (doc_id) GROUP BY d.doc_id",
    "schema_map_conf": f"WITH {entities()}, {CLEANED} SELECT d.doc_id, " + ", ".join(f"coalesce(max(text) FILTER (type = '{t}'), '') AS {f}, coalesce(max(confidence) FILTER (type = '{t}'), 0.0) AS {f}_conf" for t, f in (("NAME", "full_name"), ("GENDER", "gender"))) + " FROM (SELECT doc_id FROM documents) d LEFT JOIN ded USING (doc_id) GROUP BY d.doc_id",
    "tfidf_weights": f"WITH {corpus_sql()} SELECT doc_type, term, round(weight, 4) AS weight, round(idf, 4) AS idf FROM idx",
    "tfidf_detect": rf"""WITH {corpus_sql()}, qw AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '')) AS term FROM documents),
qn AS (SELECT doc_id, term, (1 + ln(count(*))) * any_value(idf) AS v FROM qw JOIN idfs USING (term) GROUP BY doc_id, term),
norms AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM qn GROUP BY doc_id)
SELECT doc_id, doc_type, round(sum(v * weight) / any_value(norm), 4) AS score FROM qn JOIN idx USING (term) JOIN norms USING (doc_id) GROUP BY doc_id, doc_type""",
    "tfidf_weights_lang": f"WITH {lang_corpus_sql()} SELECT doc_type, term, round(weight, 4) AS weight, round(idf, 4) AS idf FROM idx",
    "tfidf_detect_lang": f"WITH {lang_corpus_sql()}, {TURNS}, {TURN_SCORES} SELECT key, doc_type, round(score, 4) AS score FROM cosines",
    "detect_lang": f"""WITH {lang_corpus_sql()}, {TURNS}, {TURN_SCORES}, {keyword_sql('key', 'turns')},
kb AS (SELECT key, sum(score) AS total, arg_min(doc_type, struct_pack(a := -score, b := ord)) AS best, max(score) AS top FROM scores GROUP BY key),
ks AS (SELECT *, CASE WHEN total > 0 THEN round(top / total, 4) ELSE 0 END AS share FROM kb),
tb AS (SELECT key, sum(score) AS total, arg_min(doc_type, struct_pack(a := -score, b := doc_type)) AS best, max(score) AS first, coalesce(list_reverse_sort(list(score))[2], 0) AS second FROM cosines GROUP BY key),
ts AS (SELECT *, round(first / total, 4) AS share FROM tb WHERE first >= 0.10 AND NOT (second > 0 AND first / (second + 1e-9) < 1.03))
SELECT key, CASE WHEN ts.key IS NOT NULL THEN CASE WHEN ts.share >= 0.25 THEN ts.best END WHEN ks.total > 0 AND ks.share >= 0.25 THEN ks.best END AS doc_type, CASE WHEN ts.key IS NOT NULL THEN ts.share ELSE ks.share END AS confidence,
CASE WHEN ts.key IS NOT NULL THEN ts.share >= 0.25 ELSE ks.total > 0 AND ks.share >= 0.25 END AS is_confident, CASE WHEN ts.key IS NOT NULL THEN 'tfidf' WHEN ks.total > 0 THEN 'keyword' ELSE 'none' END AS method FROM ks LEFT JOIN ts USING (key)""",
    "keyword_detect": f"""WITH {keyword_sql('doc_id', 'documents')}, b AS (SELECT doc_id, sum(score) AS total, arg_min(doc_type, struct_pack(a := -score, b := ord)) AS best, max(score) AS top FROM scores GROUP BY doc_id),
s AS (SELECT *, CASE WHEN total > 0 THEN round(top / total, 4) ELSE 0 END AS share FROM b)
SELECT doc_id, CASE WHEN total > 0 AND share >= 0.25 THEN best END AS doc_type, share AS confidence, total > 0 AND share >= 0.25 AS is_confident, CASE WHEN total > 0 THEN 'keyword' ELSE 'none' END AS method FROM s""",
    "detect_topn": f"""WITH turns AS (SELECT conv_id || '-' || turn AS key, text FROM conversations), {keyword_sql('key', 'turns')},
p AS (SELECT *, CASE WHEN sum(score) OVER (PARTITION BY key) > 0 THEN round(score / sum(score) OVER (PARTITION BY key), 4) ELSE 0 END AS share FROM scores)
SELECT key, row_number() OVER (PARTITION BY key ORDER BY share DESC, ord) AS rank, doc_type, share FROM p QUALIFY row_number() OVER (PARTITION BY key ORDER BY share DESC, ord) <= 2""",
    "cosine_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_dot_product(a.v, b.v), 6) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 3""",
    "rules_build": rules_sql(),
    "entity_f1": score_sql(),
    "field_accuracy": """WITH r AS (SELECT c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN lower(c_name) WHEN c_custkey % 3 = 1 THEN c_name || 'x' END AS got, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS want FROM customer)
SELECT c_mktsegment, count(*) FILTER (want <> '' AND lower(want) = lower(coalesce(got, ''))) AS correct, count(*) FILTER (want <> '') AS total, round(count(*) FILTER (want <> '' AND lower(want) = lower(coalesce(got, ''))) / greatest(count(*) FILTER (want <> ''), 1), 4) AS accuracy FROM r GROUP BY c_mktsegment""",
    "quality_gate": f"WITH {GATE} SELECT * FROM gate",
    "run_summary": f"WITH {GATE} SELECT status, count(*) AS n, round(max(best), 4) AS best_f1 FROM gate GROUP BY status",
    "registry_merge": f"""WITH n AS (SELECT n_nationkey AS k, {TYPE_NAME} AS t FROM nation)
SELECT t AS doc_type, {ITEM_SPACED} AS name, CASE WHEN k % 2 = 0 THEN 'o/phobert-' || t || '-ner' END AS repo_id, CASE WHEN k % 2 = 0 THEN 'hub' ELSE 'local' END AS source, k % 2 = 0 AS hub_verified, CASE WHEN k % 2 = 0 THEN 'b,c' ELSE 'a' END AS tags FROM n WHERE k % 3 <> 0 OR k % 2 = 0""",
    "registry_ttl": "SELECT event_type, count(*) FILTER (CAST(floor(epoch((SELECT max(ts) FROM events))) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) <= 86400) AS n_fresh, count(*) AS n FROM events GROUP BY event_type",
    "gen_gplx": gen_gplx_sql(),
    "gen_cccd": gen_cccd_sql(),
    "gen_giay_khai_sinh": gen_birth_sql(),
    "gen_vehicle_registration": gen_vehicle_sql(),
    "gen_giay_ra_vien": gen_discharge_sql(),
    "extract_auto": extract_sql(),
    "render_template": """WITH r AS (SELECT c_custkey, c_name AS n, upper(c_mktsegment) AS s, CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS b FROM customer),
p AS (SELECT *, 6 AS a1, 6 + length(n) + 9 AS a2, 6 + length(n) + 9 + length(s) + 13 AS a3 FROM r)
SELECT c_custkey, 'Name: ' || n || chr(10) || 'Segment ' || s || ' ()' || chr(10) || 'Balance: ' || b || '.' AS text,
'c_name:' || a1 || ':' || (a1 + length(n)) || ':' || n || '|C_MKTSEGMENT:' || a2 || ':' || (a2 + length(s)) || ':' || s || CASE WHEN b <> '' THEN '|c_acctbal_text:' || a3 || ':' || (a3 + length(b)) || ':' || b ELSE '' END AS entities FROM p""",
    "ocr_noise": noise_sql(),
}
