"""Secret scans over an incremental ledger of blobs, in DataFrame functions only.

Every version of every file (path, content) is addressed by its content: the
blob id is the SHA-256 of the text. Each rule has a version of its own. The
ledger is a table of (blob, rule, version, findings): which pairs of blob and
rule version have been scanned, and what was found. A run scans only the pairs
that the ledger lacks, each blob once however many paths and commits carry it,
appends them, and joins the findings back to all paths. ``scan_history`` does so
commit by commit and reads the written ledger again before each; a new version
of one rule scans the known blobs again for that rule alone.

Spans come from built-in functions: a pattern's matches (``regexp_extract_all``)
and the gaps between them (``split``) alternate, so running sums of their lengths
give code-point offsets. The sums run over rows (one per match, within its blob,
where the scan has put them), so a text with very many matches costs in
proportion.

A blob on very many paths is spread: its paths are counted, and where findings
meet paths those of such a blob go to as many tasks as they fill.

Nulls and odd rows: a null text counts as empty and has no findings; null and
repeated paths keep their rows; repeated ledger rows count once; extra columns
are ignored by ``secret_report`` and carried by ``redact_documents``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .spread import spread_join
from .storage import settle, shared_folder

KINDS = ("assign", "access", "hex")
#: The version of each rule; raise it with the rule.
VERSIONS = {"assign": "1", "access": "1", "hex": "1"}
#: The session setting that names a ledger to keep between runs; without it a run has its own.
LEDGER_SETTING = "spark.quillspark.secretLedger"

# The patterns; {kind: (pattern, group whose length counts, least length)}.
RULES = {
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 16),
    "hex": (r"([0-9a-f]+)", 1, 32),
}
#: What a text needs for a rule to find anything; spares the span arithmetic elsewhere.
HINTS = {"assign": RULES["assign"][0], "access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}

FINDING = "struct<start:int,kind_at:int,kind:string,end:int>"
LEDGER = f"blob string, rule string, version string, findings array<{FINDING}>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def matches(text: Column, kind: str) -> Column:
    """Array of (gap before, length, weighed length) of one rule's matches."""
    pattern, group, _ = RULES[kind]
    if kind == "hex":  # a run of 32 or more is the same span whether shorter runs match or not
        pattern = r"([0-9a-f]{32,})"
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    weighed = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)
    rows = F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"), weighed.alias("weighed")), lambda x: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), x["weighed"].alias("weighed")))
    return F.when(text.rlike(HINTS[kind]), rows).otherwise(F.array().cast("array<struct<gap:int,hit:int,weighed:int>>"))


def scan_blobs(blobs: DataFrame) -> DataFrame:
    """Ledger rows for rows of (blob, text, lacking: the rules to scan it for), dealt by blob."""
    asked = [F.struct(F.lit(k).alias("rule"), F.lit(VERSIONS[k]).alias("version"), F.lit(i).alias("kind_at"), F.lit(RULES[k][2]).alias("least"), F.when(F.array_contains("lacking", k), matches(F.col("text"), k)).alias("found")) for i, k in enumerate(KINDS)]
    rules = blobs.select("blob", F.inline(F.filter(F.array(*asked), lambda x: x["found"].isNotNull())))
    hits = rules.select("blob", "rule", "version", "kind_at", "least", F.posexplode_outer("found").alias("i", "m"))
    sofar = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.gap") + F.col("m.hit")).over(sofar).cast("int")
    placed = hits.withColumn("end", end)
    span = F.struct((F.col("end") - F.col("m.hit")).alias("start"), "kind_at", F.col("rule").alias("kind"), "end")
    listed = F.array_sort(F.collect_list(F.when(F.col("m.weighed") >= F.col("least"), span)))
    return placed.groupBy("blob", "rule").agg(F.first("version").alias("version"), listed.cast(f"array<{FINDING}>").alias("findings")).select("blob", "rule", "version", "findings")


def _current(ledger: DataFrame) -> DataFrame:
    """The ledger's rows of the rules' present versions."""
    own = reduce(lambda a, b: a | b, [(F.col("rule") == k) & (F.col("version") == v) for k, v in VERSIONS.items()])
    return ledger.where(own)


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """The ledger rows that ``versions`` (column text) need and the ledger lacks.

    Copies of a blob meet in a partial aggregate before the shuffle, one text
    per task and blob.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blobs = versions.select(blob_of(F.col("text")).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    every = F.array(*map(F.lit, KINDS))
    if ledger is None:
        return scan_blobs(blobs.withColumn("lacking", every))
    seen = _current(ledger).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    lacking = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
    return scan_blobs(blobs.join(seen, "blob", "left").withColumn("lacking", lacking).where(F.size("lacking") > 0))


def scan_history(commits: list[DataFrame], folder: str) -> DataFrame:
    """The ledger in ``folder`` (a shared Parquet table, made if it is not there) after scanning the commits in turn.

    A run that was cut off is simply run again: what it had written is known.
    """
    spark = commits[0].sparkSession
    read = lambda: spark.read.schema(LEDGER).parquet(folder)
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(folder)
    for commit in commits:
        update_ledger(commit, read()).write.mode("append").parquet(folder)
    return read()


def ledger_folder(spark: SparkSession) -> str:
    """The ledger that the session names, or a new one beside the checkpoints."""
    return spark.conf.get(LEDGER_SETTING, None) or f"{shared_folder(spark)}/secret-ledger-{uuid.uuid4().hex}"


def spread_findings(rows: DataFrame, findings: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` (with column blob) and the columns of ``findings`` (one row per blob), null where a blob has none."""
    paths = rows.select("blob").groupBy("blob").agg(F.count("*").alias("__paths"))
    return spread_join(rows, settle(findings.join(paths, "blob")), ["blob"], "__paths", by, "left")


def findings_of(versions: DataFrame, ledger: DataFrame, *carried: str) -> DataFrame:
    """The carried columns, blob and findings (of all rules, by start, then kind as listed) for every version."""
    per_rule = _current(ledger).where(F.size("findings") > 0).groupBy("blob", "rule").agg(F.first("findings").alias("findings"))
    hits = per_rule.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("findings"))
    rows = versions.select(*carried, blob_of(F.col("text")).alias("blob"))
    none = F.array().cast(f"array<{FINDING}>")
    return spread_findings(rows, hits, list(carried[:1])).select(*carried, "blob", F.coalesce("findings", none).alias("findings"))


def secret_report(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, blob per document; the ledger's findings are used, what it lacks is scanned."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    new = update_ledger(docs, ledger)
    return report_from(docs, settle(new if ledger is None else new.unionByName(ledger.select(*new.columns))))


def report_from(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """The report of documents whose blobs the ledger all holds: a join, no scan."""
    found = findings_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ledger, "doc_id")
    count = lambda k: F.size(F.filter("findings", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    listed = F.array_join(F.transform("findings", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select("doc_id", *map(count, KINDS), F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"), "blob")


def history_report(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The report of a corpus scanned as a history of two commits over a written ledger, with ``pairs_skipped``.

    The first commit holds the documents of even doc_id, the second all of them, as
    a later snapshot holds what an earlier one did. What the second commit shares
    with the first is not scanned again: ``pairs_skipped`` tells how many of its pairs
    of blob and rule the ledger held. Without ``folder`` the ledger is that of the session, or a new one.
    """
    folder = folder or ledger_folder(docs.sparkSession)
    before = scan_history([docs.where("doc_id % 2 = 0")], folder).count()
    ledger = scan_history([docs], folder)
    asked = docs.select(blob_of(F.col("text")).alias("blob")).distinct().count() * len(KINDS)
    skipped = asked - (ledger.count() - before)
    return report_from(docs, ledger).withColumn("pairs_skipped", F.lit(skipped).cast("long"))


def cleared(findings: DataFrame) -> DataFrame:
    """blob, pieces (from, length of what lies before each masked stretch), rest (where the text goes on after the last).

    Overlapping findings make one stretch.
    """
    spans = findings.select("blob", F.inline("findings"))
    order = Window.partitionBy("blob").orderBy("start", "kind_at").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(order), F.lit(0))
    opens = spans.withColumn("reach", reach)
    piece = F.when(F.col("start") >= F.col("reach"), F.struct(F.col("reach").alias("from"), (F.col("start") - F.col("reach")).alias("size")))
    return opens.groupBy("blob").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.max("end").alias("rest"))


def redact_documents(docs: DataFrame, mask: str = "[SECRET]", folder: str | None = None) -> DataFrame:
    """The documents with every stretch of findings in ``text`` replaced by ``mask`` and, where present, ``n_chars`` kept true.

    Findings come from the ledger in ``folder`` (without it that of the session, or a
    new one), in which what it lacks is scanned and written first.
    """
    names = docs.columns
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), blob_of(F.col("text")).alias("blob"))
    ledger = _current(scan_history([docs], folder or ledger_folder(docs.sparkSession)))
    found = ledger.where(F.size("findings") > 0).groupBy("blob", "rule").agg(F.first("findings").alias("findings"))
    joined = spread_findings(whole, cleared(found), ["row.text", *(["row.doc_id"] if "doc_id" in names else [])])
    text = F.col("row.text")
    # each piece is cut from the text and all are joined once
    kept = F.transform("pieces", lambda p: F.substring(text, p["from"] + 1, p["size"]))
    after = F.substring(text, F.col("rest") + 1, F.length(text))
    masked = F.concat(F.array_join(F.concat(kept, F.array(F.lit(""))), mask), after)
    hit = F.col("pieces").isNotNull()
    # the new text goes on as a column: named twice, it would be made twice
    out = joined.withColumn("masked", F.when(hit, masked))
    row = F.col("row")
    values = [F.when(hit, F.col("masked")).otherwise(row[c]).alias(c) if c == "text" else F.when(hit, F.length("masked").cast("long")).otherwise(row[c]).alias(c) if c == "n_chars" else row[c].alias(c) for c in names]
    return out.select(*values)


#: The same report in DuckDB's SQL.
REPORT_SQL = """
WITH marked AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
{parts}
), numbered AS (
  SELECT doc_id, kind_at, kind, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, weighed FROM parts
), placed AS (
  SELECT doc_id, kind_at, kind, weighed[i] AS weighed, least,
         coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS a,
         length(hits[i]) AS size
  FROM numbered
), kept AS (
  SELECT doc_id, kind_at, kind, CAST(a AS BIGINT) AS a, CAST(a + size AS BIGINT) AS b FROM placed WHERE length(weighed) >= least
), listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, kind_at) AS spans
  FROM kept GROUP BY doc_id
)
SELECT m.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(m.text) AS blob,
       3 * (SELECT count(DISTINCT text) FILTER (doc_id % 2 = 0) FROM marked) AS pairs_skipped
FROM marked m LEFT JOIN listed l ON m.doc_id = l.doc_id
"""


def report_sql() -> str:
    quoted = lambda p: p.replace("'", "''")
    parts = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS kind_at, '{kind}' AS kind, {least} AS least, regexp_split_to_array(text, '{quoted(p)}') AS gaps, regexp_extract_all(text, '{quoted(p)}', 0) AS hits, regexp_extract_all(text, '{quoted(p)}', {group}) AS weighed FROM marked WHERE regexp_matches(text, '{quoted(HINTS[kind])}')"
        for i, (kind, (p, group, least)) in enumerate(RULES.items())
    )
    return REPORT_SQL.format(parts=parts)
