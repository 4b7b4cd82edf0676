import hashlib
import html
from html.entities import name2codepoint

import duckdb

from quillspark.llm import warc

COLUMNS = "page_id warc_type record_id refers_to target_uri block_digest payload_digest content_length header block".split()


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def derived(pages):
    return warc.derive_records(warc.response_records(pages))


def test_pages_and_sql(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}'")
    assert got(derived(spark.read.parquet(path))) == sorted(con.execute(warc.derivative_sql()).fetchall(), key=str)


def test_links_headers_and_text(spark, tmp_path):
    page = '<!DOCTYPE html><html lang="FR"><head><title> A\n b </title><style>p{x:"<"}</style><script>var t="</p>";</script></head><body><!-- <p>no --><h1>É &amp;lt; 1 &lt; 2</h1><p>one<b>two</b>\n three<br>four</p></body></html>'
    rows = [(1, "http://a/", page, 0), (2, None, None, 0), (1, "http://a/", page, 0), (3, "http://b/", page, 0), (None, "", "1 < 2 & x", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, block int")
    out = derived(df).collect()
    assert len(out) == 10
    one = {r.warc_type: r for r in out if r.page_id == 1}
    assert one["conversion"].block == "A b\nÉ &lt; 1 < 2\nonetwo three\nfour"
    assert "title: A b\r\nlanguage: fr\r\n" in one["metadata"].block
    assert one["conversion"].refers_to == one["metadata"].refers_to and f"WARC-Refers-To: {one['metadata'].refers_to}\r\n" in one["conversion"].header
    assert one["conversion"].payload_digest == "sha256:" + hashlib.sha256(page.encode()).hexdigest()
    for r in out:
        assert r.content_length == len(r.block.encode()) and r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.header.endswith(f"Content-Length: {r.content_length}\r\n\r\n")
        assert ("WARC-Target-URI" in r.header) == (r.target_uri is not None)
    assert len({r.record_id for r in out}) == 8  # the repeated row repeats its records
    assert [r.block for r in out if r.page_id is None and r.warc_type == "conversion"] == ["1 < 2 & x"]
    assert [r.block for r in out if r.page_id == 2 and r.warc_type == "conversion"] == [""]
    warc.write_warc(derived(df.where("page_id = 3")).coalesce(1), str(tmp_path / "w"))
    raw = next((tmp_path / "w").glob("part*")).read_bytes()
    n = 0
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        size = int(head.rpartition(b"Content-Length: ")[2])
        assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
        raw, n = rest[size + 4 :], n + 1
    assert n == 2
    assert derived(df.where("false")).collect() == []


def test_entities_unclosed_parts_and_safe_headers(spark, tmp_path):
    """Every named entity, numeric ones, and what never ends; checked against the standard library."""
    names = "".join(f"<i>x&{n};</i>" for n in name2codepoint if n != "nbsp")
    texts = [names, "&#233;&#xE9;&#XE9;&#x1F600;&amp;eacute;", "&#0;&#55296;&#1114112;|&nosuch;|&;|&#;", "a&nbsp;&#160;b", "a<!-- x <!-- y", "<script>one" * 200 + "</b>", "p<style>q", "é" * 300_000 + "&eacute;"]
    rows = [(i, "http://a/\r\nX: y" if i else "u", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r for r in derived(df).collect() if r.warc_type == "conversion"}
    assert out[0].block == "".join("x" + html.unescape(f"&{n};") for n in name2codepoint if n != "nbsp").strip()
    assert out[1].block == "ééé😀&eacute;" and out[2].block == "\ufffd\ufffd\ufffd|&nosuch;|&;|&#;" and out[3].block == "a b"
    assert [out[i].block for i in (4, 5, 6)] == ["a", "", "p"] and out[7].block == "é" * 300_001
    assert all("\nX:" not in r.header and "%0D%0AX: y" in r.header for i, r in out.items() if i)
    con = duckdb.connect()
    df.write.parquet(str(tmp_path / "p"))
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    assert got(derived(df)) == sorted(con.execute(warc.derivative_sql()).fetchall(), key=str)


def test_responses_from_files(spark, tmp_path):
    """Records written, read back and converted: ids, dates, digests and headers of the source stay."""
    http = "HTTP/1.1 203 Odd\r\nContent-Type: text/html\r\nX-Seen: yes: twice\r\n"
    rows = [(i, f"http://a/{i}", f"<html lang=de><p>é {i}\r\n\r\nWARC/ &amp; more</p>" * (1 + 500 * (i % 3)), http if i % 2 else None, f"2020-01-0{1 + i % 9}T00:00:00Z") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, head string, seen string")
    made = warc.response_records(pages, date="seen", http="head")
    warc.write_warc(made.unionByName(warc.derive_records(made), allowMissingColumns=True).repartition(3), str(tmp_path / "w"))
    back = warc.read_responses(spark, str(tmp_path / "w"))
    columns = ["record_id", "target_uri", "date", "http", "payload", "payload_digest", "header", "block"]
    listed = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert listed(back) == listed(made) and back.count() == 40
    strip = lambda df: sorted(tuple(r[c] for c in COLUMNS if c != "page_id") for r in df.collect())
    assert strip(warc.derive_records(back)) == strip(warc.derive_records(made))
    odd = next(r for r in warc.derive_records(back).collect() if r.target_uri == "http://a/1" and r.warc_type == "metadata")
    assert odd.block.startswith("via-status: HTTP/1.1 203 Odd\r\nvia-Content-Type: text/html\r\nvia-X-Seen: yes: twice\r\nvia-payload-length: ")
    assert "WARC-Date: 2020-01-02T00:00:00Z\r\n" in odd.header and odd.refers_to in {r.record_id for r in made.collect()}
