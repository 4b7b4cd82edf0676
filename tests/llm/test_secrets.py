import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from quillspark.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    out.sort()
    kinds = [x[2] for x in out]
    listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in out)
    return (*(kinds.count(k) for k in secrets.KINDS), hashlib.sha256(listed.encode()).hexdigest(), listed)


def texts(n):
    rnd = random.Random(n)
    bits = ["password", "PassWD", "secret", "toKen", "api_key", "APIKEY", "ſecret", "'", '"', " ", "  ", ":", "=", "\n", "é", "😀", "abcdef12", "A1+/_.=-", "AKIA", "AKIAABCDEFGHIJKL", "0123456789abcdef" * 2, "deadbeef" * 5, "x", "ABCDEFGHIJKLMNOP"]
    return [None, "", " "] + ["".join(rnd.choices(bits, k=rnd.randrange(1, 25))) for _ in range(n)]


def as_rows(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")) for r in df.collect()), key=str)


def test_random_texts(spark):
    rows = list(enumerate(texts(1500)))
    docs = spark.createDataFrame([(d, t, "b", "f") for d, t in rows], "doc_id long, text string, blob string, findings string")
    assert as_rows(secrets.secret_report(docs)) == sorted(((d, *brute(t)) for d, t in rows), key=str)


def test_documents_and_sql(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path)
    got = as_rows(secrets.secret_report(docs))
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    assert sorted((tuple(r[:6]) for r in con.execute(secrets.report_sql()).fetchall()), key=str) == got


def test_ledger_scans_only_what_is_new(spark, monkeypatch):
    key = "token = abcdefgh12"
    first = spark.createDataFrame([(1, key), (2, "plain"), (3, key)], "doc_id long, text string")
    ledger = secrets.update_ledger(first)
    assert ledger.count() == 2 * 3  # blobs and rules
    more = first.union(spark.createDataFrame([(4, key), (5, "secret: 123456789"), (None, None), (5, "plain")], "doc_id long, text string"))
    new = secrets.update_ledger(more, ledger)
    assert new.count() == 2 * 3  # the empty text and the new secret
    want = [(0, 0), (1, 1), (2, 0), (3, 1), (4, 1), (5, 0), (5, 1)]
    for known in (ledger, ledger.union(ledger), ledger.where("rule = 'assign'")):  # repeated rows, a rule not scanned yet
        assert sorted((r.doc_id or 0, r.n_assign) for r in secrets.secret_report(more, known).collect()) == want
    assert secrets.secret_report(first.where("false")).collect() == []
    monkeypatch.setitem(secrets.VERSIONS, "hex", "2")  # a changed rule: known blobs again, for it alone
    assert sorted(r.rule for r in secrets.update_ledger(first, ledger).collect()) == ["hex", "hex"]


def test_history_over_a_written_ledger(spark, tmp_path):
    key = "token = abcdefgh12"
    commits = [spark.createDataFrame(rows, "doc_id long, text string") for rows in ([(1, key), (2, "plain")], [(3, key), (4, "x")], [(1, key), (5, None)])]
    folder = str(tmp_path / "ledger")
    assert secrets.scan_history(commits[:1], folder).count() == 2 * 3
    assert secrets.scan_history(commits, folder).count() == 4 * 3  # what the run before wrote is not scanned again
    assert secrets.scan_history(commits, folder).count() == 4 * 3
    docs = commits[0].union(commits[1]).union(commits[2])
    report = secrets.history_report(docs, folder)
    assert report.first().pairs_skipped == 4 * 3  # all of them: the ledger held every blob
    assert secrets.history_report(docs).first().pairs_skipped == 2 * 3  # a ledger of its own: the blobs of documents 2 and 4
    assert sorted((r.doc_id, r.spans) for r in report.collect()) == [(1, "assign:0:18"), (1, "assign:0:18"), (2, ""), (3, "assign:0:18"), (4, ""), (5, "")]
    rows = list(enumerate(texts(400)))
    docs = spark.createDataFrame(rows + rows[:50], "doc_id long, text string")
    assert as_rows(secrets.history_report(docs)) == sorted(((d, *brute(t)) for d, t in rows + rows[:50]), key=str)


def test_very_long_text_with_many_findings(spark):
    text = ("token=abcdefgh12 é " + "deadbeef" * 4 + " ") * 4000
    docs = spark.createDataFrame([(1, text, 2, 3)], "doc_id long, text string, pieces int, salt int")
    assert as_rows(secrets.secret_report(docs)) == [(1, *brute(text))]
    out = secrets.redact_documents(docs).collect()[0]
    assert out.text == "[SECRET] é [SECRET] " * 4000 and (out.pieces, out.salt) == (2, 3)


def test_redaction(spark):
    rows = [(1, "a token = deadbeefdeadbeefdeadbeefdeadbeef b é secret=123456789", 9), (2, "clean", 5), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact_documents(docs).collect()}
    assert out == {1: ("a [SECRET] b é [SECRET]", 23), 2: ("clean", 5), 3: (None, None)}
    rows = list(enumerate(texts(300)))
    again = secrets.secret_report(secrets.redact_documents(spark.createDataFrame(rows, "doc_id long, text string")))
    assert again.count() == len(rows)


@pytest.mark.parametrize("kind", secrets.KINDS)
def test_no_python_in_the_plan(spark, kind):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = secrets.secret_report(docs).withColumn("k", F.lit(kind))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
