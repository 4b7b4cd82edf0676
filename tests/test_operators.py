"""The operators on literal cases and against plain Python."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.operators import clean, decode, detect, generate, labels, mapping, metrics, noise, registry, template, tokens, windows
from quillspark.operators.labeler import ModelLabeler, RuleLabeler
from quillspark.plans import dataset, extract
from quillspark.sources import files


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def odd_strings(n, seed=1):
    rnd = random.Random(seed)
    bits = ["a", "B", "é", "é", " ", "\t", "\n", " ", " ", "​", "﻿", "\x1c", "đ", "Ằ", "-", "'", "1"]
    return ["".join(rnd.choices(bits, k=rnd.randrange(0, 14))) for _ in range(n)]


def test_text_functions(spark):
    values = odd_strings(1500)

    def cleaned(t):
        t = re.sub(r"[^\S\n]+", " ", unicodedata.normalize("NFC", t))
        t = re.sub("[​‌‍﻿]", "", t)
        return re.sub(r"\n{3,}", "\n\n", t).strip()

    assert column(spark, values, X.strip_ws) == [v.strip() for v in values]
    assert column(spark, values, X.clean_text) == [cleaned(v) for v in values]
    assert column(spark, values, X.segments) == [[s.strip() for s in v.split("\n") if s.strip()] for v in values]
    assert column(spark, values, X.word_count) == [len(v.split()) for v in values]
    assert column(spark, values, X.keyword_form) == [X.keyword_form_of(v) for v in values]
    names = ["O'NEIL-AN x", "nguyễn văn a", "Lê Van", " LÊ THỊ HẰNG ", ""]
    assert column(spark, names, X.normalize_name) == [n.strip().title() if n.strip() in (n.strip().upper(), n.strip().lower()) else n.strip() for n in names]
    dates = ["1/2/2024", "99/99/2024", "x NGÀY 3  tháng 4 năm 2020.", "2024-01-02", " 01/02/2003 ", "ngày 13 tháng 12 năm 1999"]
    assert column(spark, dates, X.normalize_date) == ["01/02/2024", "99/99/2024", "03/04/2020", "2024-01-02", "01/02/2003", "13/12/1999"]
    assert column(spark, ["căn cước", "plain", "Đ"], X.is_vietnamese) == [True, False, True]
    assert X.is_hub_id("owner/name") and not X.is_hub_id("/tmp/x/y") and not X.is_hub_id("one")


def test_tokens_and_tags(spark):
    texts = odd_strings(300, 2)
    got = column(spark, texts, lambda c: X.F.transform(tokens.tokens_with_offsets(c), lambda t: F.concat_ws("|", t["token"], t["start"].cast("string"), t["end"].cast("string"))))
    for t, g in zip(texts, got):
        assert g == [f"{m[0]}|{m.start()}|{m.end()}" for m in re.finditer("[^ \n]+", t)]
    rnd = random.Random(4)
    rows = []
    for i in range(120):
        text = " ".join("w" * rnd.randrange(1, 5) for _ in range(rnd.randrange(0, 12)))
        ents = [(rnd.choice("ab"), s, s + rnd.randrange(1, 9), rnd.choice(["VALUE", "LABEL"])) for s in sorted(rnd.randrange(0, 30) for _ in range(rnd.randrange(0, 4)))]
        rows.append((i, text, ents))
    df = spark.createDataFrame(rows, "i int, text string, entities array<struct<label:string,start:int,end:int,role:string>>")
    for ranked in (False, True):
        out = {r.i: list(r.ner_tags) for r in tokens.bio_samples(df, ranked).collect()}
        for i, text, ents in rows:
            order = sorted(range(len(ents)), key=lambda k: ((ents[k][3] != "VALUE") if ranked else 0, ents[k][1], k))
            seen, want = set(), []
            for m in re.finditer("[^ \n]+", text):
                hit = next((k for k in order if m.end() > ents[k][1] and m.start() < ents[k][2]), None)
                name = None if hit is None else ents[hit][0] + ("_" + ents[hit][3] if ranked else "")
                want.append("O" if hit is None else ("I-" if hit in seen else "B-") + name)
                seen.add(hit)
            assert out.get(i, []) == want
    sample = spark.createDataFrame([(["B-a", "O"],)], "ner_tags array<string>")
    assert tokens.missing_types(sample, ["a", "b"]).first().missing == ["b"]
    kept = tokens.known_annotations(df, ["O", "B-a", "I-a"]).collect()
    assert all(e.label == "a" for r in kept for e in r.entities) and all(r.text for r in kept)


def test_windows(spark):
    df = spark.createDataFrame([(n,) for n in range(0, 700, 7)], "n int")
    for content, step in ((254, 128), (254, 126), (10, 3)):
        got = {}
        for r in windows.window_spans(df, "n", content, step).collect():
            got.setdefault(r.n, []).append((r.start, r.end))
        for n in range(7, 700, 7):
            want, at = [], 0
            while True:
                want.append((at, min(at + content, n)))
                if at + content >= n:
                    break
                at += step
            assert sorted(got[n]) == want
    pred = spark.createDataFrame([(130, 0, "B-full_name", 0.9), (130, 1, "B-full_name", 0.85), (131, 0, "I-full_name", 0.88), (131, 1, "O", 0.3), (132, 0, "x", 0.5), (132, 1, "y", 0.5)], "pos long, win long, label string, conf double").withColumn("d", F.lit(1))
    out = {r.pos: (r.label, round(r.conf, 4)) for r in windows.merge_overlaps(pred, "d").collect()}
    assert out == {130: ("B-full_name", 0.875), 131: ("I-full_name", 0.88), 132: ("x", 0.5)}
    filled = windows.fill_gaps(windows.merge_overlaps(pred, "d"), spark.createDataFrame([(1, 134)], "d int, n int"), "n", "d").collect()
    assert len(filled) == 134 and sum(r.label == "O" for r in filled) == 131
    row = spark.createDataFrame([(list(range(10, 510)), [1] + [-100] * 499)], "ids array<int>, label_ids array<int>")
    made = windows.train_windows(row).orderBy("win").collect()
    assert len(made) == 3 and all(len(r.input_ids) == len(r.labels) == len(r.attention_mask) == 256 for r in made)
    assert made[0].input_ids[:2] == [0, 10] and made[0].labels[:2] == [-100, 1] and sum(made[2].attention_mask) == 500 - 252 + 2
    assert labels.bad_label_ids(spark.createDataFrame([([0, 5, -100, -1],)], "labels array<int>"), 3).first().n_bad == 2


def test_decode_against_state_machine(spark):
    rnd = random.Random(3)
    names = ["O", "B-a", "I-a", "B-b_VALUE", "I-b_VALUE", "S-a", "bad", "I-b"]
    rows = [(d, i, f"t{i}", i * 3, i * 3 + 2, rnd.choice(names), round(rnd.random(), 3)) for d in range(150) for i in range(rnd.randrange(1, 15))]
    df = spark.createDataFrame(rows, "d int, tok_idx int, token string, start int, end int, label string, conf double")
    want, now = [], None
    for d in range(150):
        now = None
        for _, _, tok, s, e, label, conf in sorted(r for r in rows if r[0] == d):
            if label == "O" or "-" not in label:
                now = None
                continue
            kind, name = label.split("-", 1)
            t = name.replace("_VALUE", "").upper()
            if kind not in "BI":
                continue
            if kind == "B" or now is None or now[1] != t:
                now = [d, t, tok, s, e, "B-" + name]
                want.append(now)
            else:
                now[2] += " " + tok
                now[4] = e
    got = [tuple(r)[:6] for r in decode.decode_bio(df, "d").select("d", "type", "text", "start", "end", "label").collect()]
    assert sorted(got) == sorted(map(tuple, want))


def test_cleaning_and_validation(spark):
    rows = [(1, 1, "PATIENT_ADDRESS", "Thôn An, Bình Hạng/Class:, B X. Kiến Đức", 0, 9, 0.5), (1, 2, "FULL_NAME", "  HỌ TÊN: lê thị HÀ", 9, 20, 0.9), (1, 3, "PATIENT_ADDRESS", "T. Lâm Đồng", 30, 40, 0.7), (1, 4, "GENDER", "nu", 1, 2, 0.1), (1, 5, "FULL_NAME", "Other One", 50, 60, 0.2), (1, 6, "NOTES", "Tái khám ngày cấp 1", 1, 2, 0.3), (1, 7, "NOTES", "quốc tịch", 5, 6, 0.3)]
    ents = spark.createDataFrame(rows, "doc int, ord long, type string, text string, start int, end int, confidence double")
    out = {r.type: (r.text, r.end) for r in clean.deduplicate(ents, "doc").collect()}
    assert out == {"PATIENT_ADDRESS": ("Thôn An, Bình X. Kiến Đức, T. Lâm Đồng", 40), "FULL_NAME": ("Lê Thị Hà", 20), "GENDER": ("Nữ", 2), "NOTES": ("Tái khám, quốc tịch", 6)}
    fold = {r.type: (r.text, r.end, r.confidence) for r in clean.merge_fold(ents, "doc", mergeable=("PATIENT_ADDRESS",)).collect()}
    assert fold["PATIENT_ADDRESS"] == ("Thôn An, Bình Hạng/Class:, B X. Kiến Đức T. Lâm Đồng", 40, 0.6) and fold["FULL_NAME"][1] == 20
    cases = [("ID_NUMBER", "032 049 518 607", True, False), ("DOB", "03", False, False), ("DOB", "x 01/02/2003", True, False), ("FULL_NAME", "LÊ THỊ HẰNG", False, False), ("FULL_NAME", "LÊ THỊ HÀ", True, True), ("OTHER", "", True, True), ("BHXH_CODE", "1 2", False, False)]
    df = spark.createDataFrame([(t, v) for t, v, _, _ in cases], "t string, v string")
    assert [tuple(r) for r in df.select(clean.is_valid(F.col("t"), F.col("v")), clean.is_valid(F.col("t"), F.col("v"), "repo")).collect()] == [(a, b) for _, _, a, b in cases]
    assert mapping.mapping_of_labels(["O", "B-company_name", "I-company_name", "B-tax_code", "junk"]) == {"COMPANY_NAME": "company_name", "TAX_CODE": "tax_code"}
    docs = spark.createDataFrame([(1,), (2,)], "doc int")
    wide = {r.doc: r.asDict() for r in mapping.map_entities(ents, docs, {"FULL_NAME": "name", "GENDER": "sex", "X": "x"}, "doc").collect()}
    assert wide[1] == {"doc": 1, "name": "Lê Thị Hà", "sex": "Nữ", "x": ""} and wide[2]["name"] == ""


def test_detection(spark):
    texts = ["CĂN CƯỚC CÔNG DÂN số 1 quốc tịch giới tính", "GIẤY RA VIỆN bệnh viện khoa chẩn đoán", "giấy khai sinh họ và tên", "Giấy phép lái xe hạng B2", "đăng ký xe biển số", "nothing here"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [(r.doc_type, r.method) for r in detect.detect(df, "i", "t", None).orderBy("i").collect()]
    assert [g[0] for g in got[:5]] == ["cccd", "giay_ra_vien", "giay_khai_sinh", "gplx", "vehicle_registration"] and got[5] == (None, "none")
    corpora = spark.createDataFrame([("a", "alpha beta gamma alpha"), ("b", "delta beta omega")], "doc_type string, corpus string")
    index = detect.tfidf_index(corpora)
    out = detect.detect(spark.createDataFrame([(1, "alpha gamma zz"), (2, "số")], "i int, t string"), "i", "t", index).orderBy("i").collect()
    assert (out[0].doc_type, out[0].method, out[1].method) == ("a", "tfidf", "keyword")
    rules = detect.register({"x": {"strong": ["s1"], "weak": []}}, "y", ["s2"])
    assert rules["x"]["exclude"] == ["s2"] and rules["y"]["exclude"] == ["s1"]
    assert detect.rules_of(detect.rules_frame(spark, rules)) == {t: {k: v for k, v in kinds.items() if v} for t, kinds in rules.items()}
    assert any(r.matched for r in detect.explain(df, "i", "t").collect())


def test_records_templates_noise(spark, tmp_path):
    for kind in generate.GENERATORS:
        a, b = generate.generate_records(spark, kind, 40), generate.generate_records(spark, kind, 80).repartition(5)
        assert sorted(map(tuple, a.collect())) == sorted(tuple(r) for r in b.collect() if r.row_id < 40)
    body = "Số: {{ id_number }}\nTên {{ full_name.upper() }} {{ nope }} ({{ id_number }})"
    out = template.render(generate.generate_records(spark, "cccd", 30), body, ["id_number", "full_name"])
    noisy = noise.add_noise(out, "row_id", 1.0)
    for r in out.collect():
        assert [e.label for e in r.entities] == ["id_number", "FULL_NAME", "id_number"] and all(r.text[e.start : e.end] == e.value for e in r.entities)
    changed = noisy.collect()
    assert all(r.text[e.start : e.end] == e.value for r in changed for e in r.entities)
    assert {r.text for r in changed} != {r.text for r in out.collect()}
    for r in noise.add_noise_tokens(noisy, "row_id", 1.0).collect():
        assert all(r.text[e.start : e.end] == e.value for e in r.entities)
    samples, names = dataset.build_dataset(spark, "cccd", [body, "{{ gender }}"], ["id_number", "gender"], 50, 0.5, 0.1)
    rows = samples.collect()
    assert sum(r.split == "train" for r in rows) == int(len(rows) * 0.9) and all(len(r.tokens) == len(r.ner_tags) for r in rows)
    assert names.orderBy("id").first().label == "O"
    files.write_bio(samples.select("tokens", "ner_tags", "split"), names, str(tmp_path / "bio"))
    assert spark.read.json(str(tmp_path / "bio/samples")).count() == len(rows)


def test_sources(spark, tmp_path):
    t = tmp_path / "templates" / "card"
    t.mkdir(parents=True)
    (t / "template_2.txt").write_text("B {{ x }}")
    (t / "template_1.txt").write_text("A\n{{ x }}")
    (t / "schema.yaml").write_text("doc_type: card\nentities:\n  - name: x\n    type: text\n")
    assert [tuple(r) for r in files.templates(spark, str(tmp_path / "templates")).orderBy("template_idx").collect()] == [("card", 0, "A\n{{ x }}"), ("card", 1, "B {{ x }}")]
    assert files.schema_fields(spark, str(t / "schema.yaml")).first().field == "x"
    (tmp_path / "labels.json").write_text('{"labels": ["O", "B-x"], "id2label": {"0": "O", "1": "B-x"}}')
    assert {(r.id, r.label) for r in files.label_map(spark, str(tmp_path / "labels.json")).collect()} == {(0, "O"), (1, "B-x")}
    (tmp_path / "state.json").write_text('{"log_history": [{"eval_f1": 0.5}, {"loss": 1}, {"eval_f1": 0.7}]}')
    assert files.run_log(spark, str(tmp_path / "state.json")).first().best_f1 == 0.7
    assert files.coerce({"a": "3", "b": "x"}, {"a": int, "b": float}) == {"a": 3, "b": "x"}
    listing = spark.createDataFrame([("m/config.json",), ("m/checkpoint-5/optimizer.pt",)], "path string")
    assert files.model_files(listing).count() == files.junk_files(listing).count() == 1


def test_registry_metrics_and_model(spark):
    models = spark.createDataFrame([("a", "A", None, "local", False, ["t"]), ("b", "B", "o/b", "hub", True, [])], registry.FIELDS)
    assert [r.doc_type for r in registry.doc_types(models).collect()] == ["a", "b"] and registry.available(models).count() == 2
    more = spark.createDataFrame([("a", "A2", "o/a", "hub", True, [])], registry.FIELDS)
    assert registry.model_info(registry.register(models, more), "a").first().name == "A2"
    listing = spark.createDataFrame([("o/phobert-x_y-ner",), ("p/phobert-z-ner",), ("o/else",)], "repo_id string")
    assert [r.doc_type for r in registry.published(listing, "o").collect()] == ["x_y"]
    samples = spark.createDataFrame([(1, ["a"], ["O"]), (2, ["b", "c"], ["B-x", "O"])], "i int, tokens array<string>, ner_tags array<string>")
    assert metrics.example_sample(samples, "i").first().i == 2
    toks = spark.createDataFrame([(1, i, t, 0, 1) for i, t in enumerate(["x@y.zz", "word", "12"])], "d int, tok_idx int, token string, start int, end int")
    assert [r.label for r in RuleLabeler(extract.GENERAL_RULES).label(toks, "d").orderBy("tok_idx").collect()] == ["B-email", "O", "B-number"]
    wins = spark.createDataFrame([(1, 0, 0, [5, 6]), (1, 1, 2, [7])], "d int, win long, start long, ids array<int>")
    made = ModelLabeler(lambda: lambda batch: [([f"L{i}" for i in ids], [0.5] * len(ids)) for ids in batch]).label_windows(wins, "d")
    assert sorted((r.win, r.pos, r.label) for r in made.collect()) == [(0, 0, "L5"), (0, 1, "L6"), (1, 2, "L7")]
    docs = spark.createDataFrame([(1, "write to ann@site.org 123456789")], "doc_id long, text string")
    row = extract.extract(docs, mapping=extract.GENERAL_MAPPING).first()
    assert (row.email, row.id_number, row.number) == ("ann@site.org", "123456789", "")


def test_streaming(spark, tmp_path):
    from quillspark.streaming.clean import prepare_stream, windowed_counts

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(20)
    docs.write.parquet(str(tmp_path / "in"))
    stream = prepare_stream(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("prepared").start()
    run.processAllAvailable()
    run.stop()
    assert spark.table("prepared").count() == 20
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert windowed_counts(events).agg(F.sum("n")).first()[0] == events.count()
