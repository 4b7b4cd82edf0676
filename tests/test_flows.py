import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import detect, metrics, registry, template
from quillspark.operators.labeler import BatchLabeler, TaggerWeights
from quillspark.plans.runs import ledger, progress, run_types
from quillspark.sources import versions
from quillspark.streaming.clean import run_available, sessions

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_versions_switch_whole_and_are_checked(spark, tmp_path):
    root = str(tmp_path / "store")
    assert versions.load_version(spark, root) is None and versions.newest(spark, root) is None
    a, b = spark.range(5).withColumn("x", F.lit("é")), spark.range(7).withColumn("x", F.lit(None).cast("string"))
    assert versions.commit_version(root, {"t": a, "u": b}) == 1
    assert versions.commit_version(root, {"t": a.repartition(3), "u": b.orderBy(F.desc("id"))}) == 1  # the same content
    assert versions.commit_version(root, {"t": b}) == 2
    b.write.parquet(f"{root}/data/t/version=3")  # a write that broke off before its manifest
    number, tables = versions.load_version(spark, root)
    assert number == 2 and list(tables) == ["t"] and tables["t"].count() == 7
    assert versions.commit_version(root, {"t": a}) == 3 and versions.load_version(spark, root)[1]["t"].count() == 5
    a.write.mode("append").parquet(f"{root}/data/t/version=3")
    with pytest.raises(ValueError, match="version 3 .* t"):
        versions.load_version(spark, root)
    assert versions.load_version(spark, root, 1)[1]["u"].count() == 7


def test_repeated_rows_change_a_digest(spark):
    one = spark.createDataFrame([(1,), (2,)], "a int")
    assert versions.digest(one) == versions.digest(one.orderBy(F.desc("a"))) != versions.digest(one.union(one).union(one))


def test_partitions_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)], "i int, s string")
    for part in (rows, rows, rows.where("s = 'a' AND i < 4")):
        versions.write_partitions(part, path, "s")
    assert sorted(r.i for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 5, 7, 9]


def test_detector_precedence(spark, tmp_path):
    bodies = spark.createDataFrame([("a", 0, "SOME HEADING\nName: {{ x }}"), ("b", 0, "OTHER THING\nCode: {{ y }}")], "doc_type string, template_idx int, body string")
    fields = spark.createDataFrame([("a", 0, "full_name"), ("b", 0, "code_no")], "doc_type string, ord int, field string")
    root = str(tmp_path / "s")
    none = bodies.limit(0)
    origin, rules, index = detect.load_detector(spark, (bodies, fields), [root], fields)
    assert origin == "templates" and rules["a"]["strong"] == ["some heading"] and rules["a"]["exclude"] == ["other thing"] and index.count() > 0
    versions.commit_version(root, {"rules": detect.rules_frame(spark, rules), "index": index})
    origin, again, loaded = detect.load_detector(spark, (none, fields), [root], fields)
    assert origin == "version 1" and again == rules and sorted(loaded.collect()) == sorted(index.collect())
    assert detect.load_detector(spark, None, [f"{root}x"], fields) == ("schemas", {"a": {"weak": ["full name"]}, "b": {"weak": ["code no"]}}, None)
    assert detect.load_detector(spark)[0] == "built-in"


def test_as_of_against_brute_force(spark):
    rnd = random.Random(1)
    entries = [(rnd.choice("abc"), at(rnd.randrange(5000)), i) for i in range(300)] + [("a", at(100), 900), ("a", at(100), 901), (None, at(5), 902), ("a", None, 903)]
    lookups = [(i, rnd.choice("abcd"), at(rnd.randrange(6000))) for i in range(300)] + [(900, "a", at(100)), (901, None, at(100)), (902, "a", None), (903, "b", at(50)), (903, "b", at(50))]
    rnd.shuffle(entries)
    e = spark.createDataFrame(entries, "doc_type string, since timestamp, version long")
    asked = spark.createDataFrame(lookups, "q long, doc_type string, at timestamp")
    for ttl in (7, 60, 1000):
        got = [(r.q, r.entry.version if r.entry else None) for r in registry.as_of(asked, e, "doc_type", "at", "since", ttl).collect()]
        want = []
        for q, k, t in lookups:
            fit = [(s, v) for kk, s, v in entries if k and t and kk == k and s and s <= t]
            best = max(fit, default=None)
            want.append((q, best[1] if best and (t - best[0]).total_seconds() <= ttl else None))
        assert sorted(got, key=str) == sorted(want, key=str)


def test_refresh_keeps_the_last(spark):
    rows = [("a", at(1), 1, "x"), ("a", at(1), 2, "y"), ("a", None, 9, "z"), ("b", None, None, "w"), (None, at(9), 9, "v")]
    df = spark.createDataFrame(rows, "doc_type string, since timestamp, version int, name string")
    assert sorted((r.doc_type, r.name) for r in registry.refresh(df.union(df)).collect()) == [("a", "y"), ("b", "w")]
    assert registry.export(registry.refresh(df).select("doc_type", "name"), "me").where("doc_type = 'a'").first().json == '{"owner":"me","doc_type":"a","name":"y"}'


def outcomes(calls):
    def execute(due):
        rows = due.collect()
        calls.extend((r.doc_type, r.step, r.attempt) for r in rows)
        out = []
        for r in rows:
            ok = not ((r.doc_type == "bad" and r.step == "train") or (r.doc_type == "late" and r.attempt == 1))
            out.append((r.doc_type, ok, {"weak": 0.1}.get(r.doc_type, 0.8) if r.step == "evaluate" else None, None if ok else "no"))
        return due.sparkSession.createDataFrame(out, "doc_type string, ok boolean, value double, error string")

    return execute


def test_a_broken_run_ends_as_a_straight_one(spark, tmp_path):
    types = spark.createDataFrame([(t,) for t in ("good", "bad", "late", "weak", "good")], "doc_type string")
    want = {("good", "published", 4), ("bad", "train_failed", 3), ("late", "published", 8), ("weak", "low_f1", 3)}
    straight = {(r.doc_type, r.status, r.n_attempts) for r in run_types(types, str(tmp_path / "a"), outcomes([])).collect()}
    assert straight == want
    calls, path = [], str(tmp_path / "b")
    for _ in range(9):  # one round at a time
        out = run_types(types, path, outcomes(calls), rounds=1)
    assert {(r.doc_type, r.status, r.n_attempts) for r in out.collect()} == want
    assert len(calls) == len(set(calls)) == 18  # nothing done twice
    spark.read.parquet(path).limit(5).write.mode("append").parquet(path)  # an append that was repeated
    assert {(r.doc_type, r.status, r.n_attempts) for r in run_types(types, path, outcomes(calls)).collect()} == want and len(calls) == 18
    assert progress(types.limit(1), ledger(spark, str(tmp_path / "new"))).first().step == "generate"


def test_sessions_over_deliveries(spark, tmp_path):
    def deliver(rows):
        spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("event_id long, ts timestamp, user_id long").parquet(str(tmp_path / "in"))
        run_available(sessions(stream), str(tmp_path / "out"), str(tmp_path / "state"))

    hour = 3600
    deliver([(1, at(0), 1), (2, at(1800), 1), (3, at(3 * hour), 1), (4, at(0), 2), (5, None, 2)])
    deliver([(3, at(3 * hour), 1), (6, at(3 * hour + 600), 1), (7, at(9 * hour), 1)])  # 3 again
    deliver([(8, at(1 * hour), 2), (9, at(30 * hour), 3)])  # 8 is far too late
    got = {(r.user_id, r.start, r.end, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, at(0), at(1800 + hour), 2), (2, at(0), at(hour), 1), (1, at(3 * hour), at(4 * hour + 600), 2), (1, at(9 * hour), at(10 * hour), 1)}


def test_lines_hold_their_spans(spark):
    rows = spark.createDataFrame([(i, f"v{i}", None if i % 3 else "Name", i) for i in range(200)], "k long, a string, b string, c int")
    fields = {"a": (F.col("a"), ["Name", "Title"]), "b": (F.col("b"), ["Name"]), "c": (F.col("c"), ["No."])}
    out = template.build_lines(rows, "k", fields, [": ", "\n", " "], [("a", "b", 0.5)]).collect()
    again = {r.k: (r.text, r.spans) for r in template.build_lines(rows.repartition(7), "k", fields, [": ", "\n", " "], [("a", "b", 0.5)]).collect()}
    orders, merged = set(), 0
    for r in out:
        assert again[r.k] == (r.text, r.spans)
        found = {(s.label, s.role): r.text[s.start : s.end] for s in r.spans}
        assert found["a", "VALUE"] == r.a and found["c", "VALUE"] == str(r.c) and found["b", "LABEL"] == "Name" and found.get(("b", "VALUE")) == (None if r.k % 3 else "Name")
        assert found["a", "LABEL"] in ("Name", "Title") and len(r.spans) == (5 if r.k % 3 else 6)
        orders.add(tuple(s.label for s in r.spans if s.role == "LABEL"))
        merged += "  " in r.text
    assert len(orders) == 6 and 70 < merged < 130


def test_card_rows_tell_nulls_from_totals(spark):
    df = spark.createDataFrame([("t", None), ("t", "x"), ("v", None)], "split string, lang string")
    got = [(r.level, r.split, r.lang, r.n) for r in metrics.card_rows(df, "split", "lang").collect()]
    assert [g for g in got if g[0] == ""] == [("", None, None, 3)] and ("lang", None, None, 2) in got and ("split,lang", "t", None, 1) in got and len(got) == 8
    text = metrics.card_text(metrics.card_rows(df, "split", "lang"), "set", "split", "lang").first().card
    assert text.startswith("# set\n3 rows\n## lang\n| - | 2 |\n| x | 1 |\n## split\n")
    assert metrics.card_text(metrics.card_rows(df.limit(0), "split", "lang"), "set", "split", "lang").first().card == "# set\n0 rows\n"


def test_batch_labeler_is_the_model(spark):
    rng = np.random.default_rng(0)
    model = TaggerWeights(["O", "B-x", "I-x"], rng.normal(size=(7, 3)))
    ids = [rng.integers(0, 50, n).tolist() for n in (1, 5, 8, 3)]
    df = spark.createDataFrame([(i, 0, 10 * i, x) for i, x in enumerate(ids)], "doc_id long, win long, start long, ids array<int>")
    got = {(r.doc_id, r.pos): (r.label, r.conf) for r in BatchLabeler(model, 8, 2).label_windows(df, "doc_id").collect()}
    want = {}
    for i, row in enumerate(ids):
        for j, x in enumerate(row):
            p = np.exp(model.scores[x % 7])
            p /= p.sum()
            want[i, 10 * i + j] = (model.labels[int(p.argmax())], p.max())
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in got)
