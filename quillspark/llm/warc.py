"""WARC derivatives: responses into linked metadata and plain-text conversion records.

The input are response records: from WARC files (``read_responses``), or made of
pages (``response_records``: a page is the payload of an HTTP response with the
headers that came with it, or plain ones). Two records derive from each: a
``metadata`` record (application/warc-fields: every header of the source's HTTP
response after ``via-``, length and digest of its payload, title and language)
and a ``conversion`` record (text/plain: the visible text). Both point with
``WARC-Refers-To`` to the response's own id and keep its target URI, date and
payload digest. Ids that are made here follow from the content, so a rerun makes
the same records and a copy of a page at another URI makes other ones.

Everything is a projection of one row: no shuffle, no state. The HTML is read
with regular expressions that are linear in the text: comments, scripts and
styles go (an unclosed one goes up to the end, as in browsers), block tags become
line ends, other tags vanish, the title stays as the first line, named and
numeric entities are decoded once, white space is collapsed.

Nulls and odd rows: a null page has an empty payload; a null URI leaves the header
out, line ends in one are escaped; repeated rows give repeated records with the
same ids; a numeric entity outside Unicode becomes U+FFFD, an unknown name stays;
extra columns are ignored.
"""

from __future__ import annotations

from html import unescape
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SOFTWARE = "quillspark-warc/1"
CRLF = "\r\n"

# Elements that end a line, and entities.
BLOCK_TAGS = "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
#: Named entities, the frequent ones first; a no-break space counts as a space.
FREQUENT = ("amp", "nbsp", "quot", "lt", "gt", "copy", "middot")
ENTITIES = {n: " " if n == "nbsp" else unescape(f"&{n};") for n in sorted([*name2codepoint, "apos"], key=lambda n: (n not in FREQUENT, n))}
ENTITY = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
#: Applied in turn: (pattern, replacement); RE2 and Java read them alike.
CLEANING = (
    (r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)|<noscript\b[^>]*>.*?(?:</noscript\s*>|\z)", " "),
    (r"[\t\n\x0B\f\r]", " "),
    (rf"(?i)</?({BLOCK_TAGS})(\s[^>]*)?/?>", "\n"),
    (r"<[/!?a-zA-Z][^>]*>", ""),
)
TIDYING = ((r" +\n[ \n]*|\n[ \n]+", "\n"), (r" {2,}", " "))


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def entity(name: Column) -> Column:
    """What stands for an entity (without & and ;)."""
    digits = F.when(F.lower(F.substring(name, 1, 2)) == "#x", F.substring(name, 3, 9)).otherwise(F.conv(F.substring(name, 2, 9), 10, 16))
    number = F.conv(digits, 16, 10).cast("long")
    sound = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    char = F.when(number == 160, " ").when(sound, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")).otherwise("\ufffd")
    named = F.create_map(*(F.lit(x) for pair in ENTITIES.items() for x in pair))
    return F.when(F.startswith(name, F.lit("#")), char).otherwise(F.coalesce(F.try_element_at(named, name), F.concat(F.lit("&"), name, F.lit(";"))))


def decoded(text: Column) -> Column:
    def use(t: Column) -> Column:
        gaps = F.split(t, ENTITY.replace("(", "(?:", 1), -1)
        names = F.regexp_extract_all(t, F.lit(ENTITY), F.lit(1))
        pieces = F.zip_with(gaps, F.transform(names, entity), lambda g, e: F.concat(g, F.coalesce(e, F.lit(""))))
        return F.when(F.contains(t, F.lit("&")), F.array_join(pieces, "")).otherwise(t)

    return bound(text, use)


def visible_text(html: Column) -> Column:
    """The visible text of HTML; a block element starts and ends a line."""
    for pattern, by in CLEANING:
        html = F.regexp_replace(html, pattern, by)
    html = decoded(html)
    for pattern, by in TIDYING:
        html = F.regexp_replace(html, pattern, by)
    return F.trim(html, F.lit(" \n"))


def record_id(*parts: Column) -> Column:
    """urn:uuid from the SHA-256 of the parts."""
    h = F.sha2(F.concat_ws("\n", *parts), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def header(fields: list[tuple[str, Column]]) -> Column:
    """The WARC header block; a field whose value is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines), F.lit(CRLF + CRLF))


DATE = "2024-01-01T00:00:00Z"


def digest(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def safe(uri: Column) -> Column:
    """A URI that cannot break a header line."""
    return F.replace(F.replace(uri, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def response_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str | None = None, http: str | None = None) -> DataFrame:
    """page_id, record_id, target_uri, date, http, payload, payload_digest, header, block of a response record per page.

    ``date`` and ``http`` name columns with the fetch time and the response's
    status line and headers, where a table has them.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    plain = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "), F.octet_length("payload").cast("string"), F.lit(CRLF))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), safe(F.col(url).cast("string")).alias("target_uri"), (F.col(date).cast("string") if date else F.lit(DATE)).alias("date"), (F.col(http).cast("string") if http else F.lit(None).cast("string")).alias("http"), payload.alias("payload"))
    rows = rows.withColumn("http", F.coalesce("http", plain)).withColumn("payload_digest", digest(F.col("payload")))
    rows = rows.withColumn("record_id", record_id(F.lit("response"), F.coalesce("target_uri", F.lit("")), F.col("payload_digest")))
    rows = rows.withColumn("block", F.concat("http", F.lit(CRLF), "payload"))
    head = header([("WARC-Type", F.lit("response")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Target-URI", F.col("target_uri")), ("WARC-Date", F.col("date")), ("WARC-Payload-Digest", F.col("payload_digest")),
                   ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", F.octet_length("block").cast("string"))])
    return rows.select("page_id", "record_id", "target_uri", "date", "http", "payload", "payload_digest", head.alias("header"), "block")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The response records of WARC files (plain, or gzip with a member per record), columns as ``response_records``.

    Files are cut where a record's end meets the next one's version line, so large
    plain files are read in splits; a block ends where its length says.
    """
    first = F.startswith("value", F.lit("WARC/1."))
    raw = spark.read.option("lineSep", f"{CRLF}{CRLF}WARC/1.").text(path).select(F.when(first, F.col("value")).otherwise(F.concat(F.lit("WARC/1."), "value")).alias("value"))
    raw = raw.withColumn("head", F.substring_index("value", CRLF * 2, 1))
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*(.*?)[ \t\r]*$", 1), F.lit(""))
    rows = raw.where(field("WARC-Type") == "response")
    body = F.substring(F.col("value").cast("binary"), F.octet_length("head") + 5, field("Content-Length").cast("int")).cast("string")
    rows = rows.select(field("WARC-Record-ID").alias("record_id"), field("WARC-Target-URI").alias("target_uri"), field("WARC-Date").alias("date"), field("WARC-Payload-Digest").alias("given"), F.concat("head", F.lit(CRLF * 2)).alias("header"), body.alias("block"))
    http = F.concat(F.substring_index("block", CRLF * 2, 1), F.lit(CRLF))
    rows = rows.withColumn("http", http).withColumn("payload", F.substr("block", F.length("http") + 3))
    return rows.select(F.xxhash64("record_id").alias("page_id"), "record_id", "target_uri", "date", "http", "payload", F.coalesce("given", digest(F.col("payload"))).alias("payload_digest"), "header", "block")


def derive_records(responses: DataFrame) -> DataFrame:
    """page_id, warc_type, record_id, refers_to, target_uri, block_digest, payload_digest, content_length, header, block.

    Lengths are in bytes of UTF-8. The record is header + block + CRLF CRLF.
    """
    rows = responses.select("page_id", F.col("record_id").alias("source_id"), "target_uri", "date", F.regexp_replace("http", r"[\r\n]+\z", "").alias("http"), "payload_digest", F.col("payload").alias("html"))
    title = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>([^<]*)</title", 1), r"[\t\n\x0B\f\r ]+", " "))
    language = F.regexp_extract("html", r"""(?is)<html[^>]*\slang=["']?([A-Za-z-]+)""", 1)
    via = F.regexp_replace(F.concat(F.lit("status: "), F.col("http")), r"(?m)^", "via-")
    fields = F.concat_ws(
        CRLF,
        via,
        F.concat(F.lit("via-payload-length: "), F.octet_length("html").cast("string")),
        F.concat(F.lit("via-payload-digest: "), F.col("payload_digest")),
        F.when(title != "", F.concat(F.lit("title: "), title)),
        F.when(language != "", F.concat(F.lit("language: "), F.lower(language))),
        F.lit(""),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=UTF-8").alias("content_type"), visible_text(F.col("html")).alias("block")),
    )
    kept = ("page_id", "target_uri", "source_id", "date", "payload_digest")
    rows = rows.select(*kept, F.explode(kinds).alias("r"))
    rows = rows.select(*kept, "r.*").withColumn("block_digest", digest(F.col("block"))).withColumn("content_length", F.octet_length("block").cast("long"))
    rows = rows.withColumn("record_id", record_id(F.col("warc_type"), F.col("source_id"), F.col("block_digest")))
    head = header(
        [
            ("WARC-Type", F.col("warc_type")),
            ("WARC-Record-ID", F.col("record_id")),
            ("WARC-Refers-To", F.col("source_id")),
            ("WARC-Target-URI", F.col("target_uri")),
            ("WARC-Date", F.col("date")),
            ("WARC-Block-Digest", F.col("block_digest")),
            ("WARC-Source-Payload-Digest", F.col("payload_digest")),
            ("Software", F.lit(SOFTWARE)),
            ("Content-Type", F.col("content_type")),
            ("Content-Length", F.col("content_length").cast("string")),
        ]
    )
    return rows.select("page_id", "warc_type", "record_id", F.col("source_id").alias("refers_to"), "target_uri", "block_digest", "payload_digest", "content_length", head.alias("header"), "block")


def write_warc(records: DataFrame, path: str) -> None:
    """Records (columns header, block) as files of WARC 1.1, one per partition."""
    records.select(F.concat("header", "block", F.lit("\r\n\r")).alias("value")).write.option("lineSep", "\n").text(path)


def derivative_sql() -> str:
    """The records derived from pages, in DuckDB's SQL."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    text = "html"
    for pattern, by in CLEANING:
        text = f"regexp_replace({text}, {q(pattern)}, {q(by)}, 'g')"
    named = f"MAP([{', '.join(map(q, ENTITIES))}], [{', '.join(map(q, ENTITIES.values()))}])"
    number = "CASE WHEN e[2:2] IN ('x', 'X') THEN CAST('0x' || e[3:] AS BIGINT) ELSE CAST(e[2:] AS BIGINT) END"
    char = f"CASE WHEN {number} = 160 THEN ' ' WHEN {number} BETWEEN 1 AND 55295 OR {number} BETWEEN 57344 AND 1114111 THEN chr(CAST({number} AS INTEGER)) ELSE chr(65533) END"
    entity_of = f"CASE WHEN e[1:1] = '#' THEN {char} ELSE coalesce({named}[e], '&' || e || ';') END"
    tidy = "array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || coalesce(marks[i], '')), '')"
    for pattern, by in TIDYING:
        tidy = f"regexp_replace({tidy}, {q(pattern)}, {q(by)}, 'g')"
    tidy = f"trim({tidy}, ' ' || chr(10))"
    crlf = "chr(13) || chr(10)"
    uuid = lambda h: f"'<urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-' || {h}[13:16] || '-' || {h}[17:20] || '-' || {h}[21:32] || '>'"
    names = (("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "source_id"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", q(DATE)), ("WARC-Block-Digest", "block_digest"), ("WARC-Source-Payload-Digest", "source_digest"), ("Software", q(SOFTWARE)), ("Content-Type", "content_type"), ("Content-Length", "CAST(content_length AS VARCHAR)"))
    head = " || ".join(f"coalesce({q(n + ': ')} || {v} || {crlf}, '')" for n, v in names)
    title_pattern, language_pattern = q(r"(?is)<title[^>]*>([^<]*)</title"), q(r"""(?is)<html[^>]*\slang=["']?([A-Za-z-]+)""")
    return rf"""
WITH pages_in AS (SELECT page_id, replace(replace(url, chr(13), '%0D'), chr(10), '%0A') AS target_uri, coalesce(html, '') AS html FROM pages),
dug AS (SELECT *, 'sha256:' || sha256(html) AS source_digest,
  trim(regexp_replace(regexp_extract(html, {title_pattern}, 1), '[\t\n\x0B\f\r ]+', ' ', 'g'), ' ') AS title, regexp_extract(html, {language_pattern}, 1) AS language, {text} AS bare FROM pages_in),
hashed AS (SELECT *, sha256('response' || chr(10) || coalesce(target_uri, '') || chr(10) || source_digest) AS h, regexp_split_to_array(bare, {q(ENTITY.replace("(", "(?:", 1))}) AS gaps,
  list_transform(regexp_extract_all(bare, {q(ENTITY)}, 1), lambda e: {entity_of}) AS marks FROM dug),
sourced AS (SELECT *, {uuid('h')} AS source_id FROM hashed),
derived AS (
  SELECT page_id, target_uri, source_id, source_digest, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
    'via-status: HTTP/1.1 200 OK' || {crlf} || 'via-Content-Type: text/html; charset=UTF-8' || {crlf} || 'via-Content-Length: ' || strlen(html) || {crlf} || 'via-payload-length: ' || strlen(html) || {crlf} || 'via-payload-digest: ' || source_digest || {crlf}
    || CASE WHEN title <> '' THEN 'title: ' || title || {crlf} ELSE '' END || CASE WHEN language <> '' THEN 'language: ' || lower(language) || {crlf} ELSE '' END AS block FROM sourced
  UNION ALL
  SELECT page_id, target_uri, source_id, source_digest, 'conversion', 'text/plain; charset=UTF-8', {tidy} FROM sourced
), sized AS (SELECT *, 'sha256:' || sha256(block) AS block_digest, CAST(strlen(block) AS BIGINT) AS content_length FROM derived),
keyed AS (SELECT *, sha256(warc_type || chr(10) || source_id || chr(10) || block_digest) AS k FROM sized),
named AS (SELECT *, {uuid('k')} AS record_id FROM keyed)
SELECT page_id, warc_type, record_id, source_id AS refers_to, target_uri, block_digest, source_digest AS payload_digest, content_length,
  'WARC/1.1' || {crlf} || {head} || {crlf} AS header, block FROM named
"""
