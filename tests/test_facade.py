import json

import pytest
from pyspark.sql import functions as F

from quillspark.operators.clean import deduplicate
from quillspark.operators.labeler import RuleLabeler
from quillspark.operators.mapping import DEFAULT_MAPPINGS, map_entities
from quillspark.plans import facade
from quillspark.plans.facade import Extractor
from quillspark.sources import models

MAPPING = "doc_type string, ord long, etype string, field string"
SCHEMA = "doc_type string, ord long, field string"
ENTITIES = "array<struct<ord:long,type:string,text:string,start:long,end:long,label:string,confidence:double>>"


def entity(ord_, etype, text, confidence=0.5):
    return (ord_, etype, text, 10 * ord_, 10 * ord_ + 5, f"B-{etype}", confidence)


def test_label_maps_of_model_folders(spark, tmp_path):
    def put(doc_type, **files):
        (tmp_path / doc_type).mkdir()
        for name, value in files.items():
            (tmp_path / doc_type / f"{name}.json").write_text(value if isinstance(value, str) else json.dumps(value))

    own = {"id2label": {"0": "O", "1": "B-a", "10": "I-a", "2": "B-a"}, "hidden": 3}
    put("plain", config=own)
    put("ids", config=own, label_map={"id2label": {"7": "B-x"}})
    put("labels", config=own, label_map={"label2id": {"B-y": 4}})
    put("both", config=own, label_map={"id2label": {"1": "B-z"}, "label2id": {"B-z": 9}})
    put("broken", config=own, label_map="{not json")
    put("odd", config={"id2label": {"x": "B-a", "3": "B-b"}})
    put("none", config={"hidden": 1})
    (tmp_path / "plain" / "tokenizer.json").write_text(json.dumps({"id2label": {"5": "no"}}))
    found = {r.doc_type: (r.id2label, r.label2id) for r in models.model_label_maps(spark, str(tmp_path)).collect()}
    ids, inverse = {0: "O", 1: "B-a", 2: "B-a", 10: "I-a"}, {"O": 0, "B-a": 2, "I-a": 10}
    assert found == {
        "plain": (ids, inverse), "ids": ({7: "B-x"}, inverse), "labels": (ids, {"B-y": 4}), "both": ({1: "B-z"}, {"B-z": 9}),
        "broken": (ids, inverse), "odd": ({3: "B-b"}, {"B-b": 3}), "none": (None, None),
    }


def test_precedence_is_whole_per_type(spark):
    labels = spark.createDataFrame([("a", 0, "O"), ("a", 3, "I-name_VALUE"), ("a", 2, "B-name"), ("a", 4, "S-no"), ("a", 5, "B-"), ("cccd", 1, "B-only"), ("b", 1, "B-x"), (None, 1, "B-x"), ("o", 0, "O")], "doc_type string, id long, label string")
    explicit = spark.createDataFrame([("b", 0, "Y", "yy"), ("b", 1, "Y", "late"), ("b", 2, None, "n")], MAPPING)
    e = Extractor.load(spark, labels, explicit=explicit)
    rows = {(r.doc_type, r.etype): (r.field, r.origin) for r in e.mappings.collect()}
    assert {k: v for k, v in rows.items() if k[0] in ("a", "b", "cccd", "o", None)} == {("a", "NAME"): ("name", "labels"), ("b", "Y"): ("yy", "explicit"), ("cccd", "ONLY"): ("only", "labels")}
    assert {k[1]: v[0] for k, v in rows.items() if k[0] == "giay_ra_vien"} == DEFAULT_MAPPINGS["giay_ra_vien"]


def test_schema_and_fields_of_one_type(spark):
    schemas = spark.createDataFrame([("cccd", 1, "b"), ("cccd", 0, "a"), ("cccd", 2, "b"), ("only", 0, "z"), ("cccd", 3, None)], SCHEMA)
    e = Extractor.load(spark, schemas=schemas)
    with pytest.raises(ValueError):
        e.get_fields()
    with pytest.raises(ValueError):
        e.extract(spark.createDataFrame([(1, "x")], "doc_id long, text string"))
    assert [r.field for r in e.for_doc("cccd").get_fields().collect()] == ["a", "b"]
    assert [r.field for r in e.get_fields("only").collect()] == ["z"]
    assert {r.etype: r.field for r in e.get_schema("cccd").collect()} == DEFAULT_MAPPINGS["cccd"]
    assert [r.field for r in e.get_fields("giay_ra_vien").collect()] == sorted(set(DEFAULT_MAPPINGS["giay_ra_vien"].values()))
    assert e.get_fields("unknown").count() == 0


@pytest.mark.parametrize("most", [200_000, 0])  # broadcast, and the join by shuffle
def test_each_document_by_its_own_type(spark, monkeypatch, most):
    monkeypatch.setattr(facade, "MOST_ENTRIES", most)
    rows = spark.createDataFrame(
        [
            (1, "a", [entity(1, "NAME", "ann lee"), entity(2, "NICK", "al", 0.25), entity(3, "GENDER", "nam"), entity(4, "ADDRESS", "x 1"), entity(5, "ADDRESS", "y 2")], "c"),
            (1, "b", [entity(1, "NAME", "ann"), entity(2, "GENDER", "robot")], "c"),  # the id again, another type
            (2, "a", [], "c"),
            (3, "unknown", [entity(1, "NAME", "x")], "c"),
            (4, None, [entity(1, "NAME", "x")], "c"),
            (None, "a", None, None),
        ],
        f"doc_id long, doc_type string, entities {ENTITIES}, mapping string",
    )
    mappings = spark.createDataFrame([("a", 0, "NAME", "name"), ("a", 1, "NICK", "name"), ("a", 2, "ADDRESS", "address"), ("a", 3, "GENDER", "unexpected"), ("b", 0, "GENDER", "gender"), ("b", 1, "NAME", "who")], MAPPING)
    fields = facade.expected_fields(mappings, spark.createDataFrame([("a", 0, "name"), ("a", 1, "address"), ("a", 2, "more")], SCHEMA))
    types = facade.type_table(mappings, fields)
    got = sorted(((r.doc_id or 0, r.doc_type or "", r.record) for r in facade.typed_records(rows, types, "doc_id").collect()), key=lambda r: r[:2])
    empty = {"name": "", "address": "", "more": ""}
    assert got == [
        (0, "a", empty), (1, "a", {"name": "al", "address": "x 1, y 2", "more": ""}), (1, "b", {"gender": "", "who": "Ann"}),
        (2, "a", empty), (3, "unknown", {}), (4, "", None),
    ]
    sure = {(r.doc_id, r.doc_type): r.record for r in facade.typed_records(rows, types, "doc_id", clean=False, validate=False, with_confidence=True).collect()}
    assert sure[1, "a"]["name"] == ("al", 0.25) and sure[1, "a"]["address"] == ("y 2", 0.5) and sure[1, "b"]["gender"] == ("robot", 0.5) and sure[2, "a"]["more"] == ("", 0.0)
    assert facade.typed_records(rows.limit(0), types, "doc_id").count() == 0
    assert {str(r.record) for r in facade.typed_records(rows, types.limit(0), "doc_id").collect()} == {"{}", "None"}


def test_one_type_equals_the_mapping_of_rows(spark):
    docs = spark.createDataFrame([(i, [entity(j, "NAME ADDRESS GENDER NOTES".split()[(i + j * j) % 4], f"  t{i} HỌ TÊN x{j}") for j in range(1, i % 6 + 1)]) for i in range(40)], f"doc_id long, entities {ENTITIES}")
    mapping = {"NAME": "name", "ADDRESS": "address", "NOTES": "address", "GENDER": "gender"}
    entities = docs.select("doc_id", F.inline("entities"))
    want = {r.doc_id: {f: r[f] for f in ("name", "address", "gender")} for r in map_entities(entities, docs, mapping, "doc_id").collect()}
    rows = spark.createDataFrame([("t", i, e, f) for i, (e, f) in enumerate(mapping.items())], MAPPING)
    types = facade.type_table(rows, facade.expected_fields(rows, spark.createDataFrame([], SCHEMA)))
    got = {r.doc_id: r.record for r in facade.typed_records(docs.withColumn("doc_type", F.lit("t")), types, "doc_id").collect()}
    assert got == want and deduplicate(entities, "doc_id").count() > 0


def test_detected_types_keep_repeated_and_odd_rows(spark):
    rules = {"card": {"strong": ["plastic"]}, "bill": {"strong": ["amount due"]}}
    explicit = spark.createDataFrame([("card", 0, "NUMBER", "number"), ("bill", 0, "EMAIL", "mail")], MAPPING)
    e = Extractor.load(spark, explicit=explicit, labeler=RuleLabeler([(r"@", "email"), (r"[0-9]", "number")]))
    docs = spark.createDataFrame([(1, "plastic 123 a@b.c", "k"), (1, "plastic 123 a@b.c", "k"), (2, "amount due a@b.c 7", "k"), (3, "nothing 5", "k"), (None, None, None), (4, "", "k")], "doc_id long, text string, method string")
    got = sorted(((r.doc_id or 0, r.doc_type or "", r.method, str(r.record)) for r in e.extract_auto(docs, rules=rules).collect()))
    card = (1, "card", "keyword", "{'number': '123'}")
    assert got == [(0, "", "none", "None"), card, card, (2, "bill", "keyword", "{'mail': 'a@b.c'}"), (3, "", "none", "None"), (4, "", "none", "None")]
    assert e.extract_raw(docs.where("doc_id = 2")).count() == 2
