"""Draws, cleaning, keywords and first entities of whole arrays against what they stand for."""

import random
import re
import unicodedata
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.functions.draws import place_draws
from quillspark.functions.portions import in_portions
from quillspark.operators import clean
from quillspark.operators.decode import ENTITIES
from quillspark.operators.labeler import HashLabeler, entity_spans, first_spans
from quillspark.plans import facade_queries
from tests.conftest import SF

TYPES = ("NAME", "PATIENT_ADDRESS", "NOTES", "GENDER", "DIAGNOSIS", "PLACE_OF_ORIGIN")
PIECES = ["họ tên: ", "HỌ TÊN/Full Name  ", "Quê quán ", "x", "Hạng/Class:, B2", "class C1é", "CLASS", "hạng: ", " Ngày cấp ", "gender", "İ", " ,.;", "  ", " ", "\t", "nu", "NO", "An", "số i no.", "é", ": "]


def test_draws_are_digests():
    heads, sizes = [b"42|%d|" % k for k in (5, 77, 123456)] + [b"42|", b"x" * 50, b"y" * 40], np.array([3, 120, 1500, 0, 11, 105])
    want = [int.from_bytes(md5(h + b"%d|label" % i).digest()[:4], "big") / 4294967296.0 for h, n in zip(heads, sizes) for i in range(n)]
    assert place_draws(heads, sizes, b"|label").tolist() == want and len(place_draws([], np.zeros(0, np.int64), b"|x")) == 0


def test_texts_tidied_and_keywords_at_once(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(" \t\n  \x1f\x85​﻿aéÉ　ßİΣ一Z9.") for _ in range(rnd.randrange(14))) for _ in range(3000)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    for r in df.select("t", X.clean_text(F.col("t")).alias("a"), X.tidy(X.nfc("t")).alias("b"), X.keyword_form(F.col("t")).alias("k")).collect():
        assert r.a == r.b
        if r.t is not None:
            kept = "".join(c for c in r.t.lower().translate(X.UNACCENTED) if unicodedata.category(c) != "Mn")
            assert r.k == re.sub("[^a-z0-9]+", " ", kept).strip(" ")


def test_first_entities_of_arrays_are_as_by_columns(spark):
    rnd = random.Random(4)
    docs = [(i, [(j, rnd.choice(TYPES), "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(1, 6))), j, j + 1, "B-x", j / 8) for j in range(1, rnd.randrange(1, 12))]) for i in range(400)] + [(400, []), (401, None)]
    df = spark.createDataFrame(docs, "id long, e array<struct<ord:long,type:string,text:string,start:long,end:long,label:string,confidence:double>>")
    assert df.schema["e"].dataType.elementType.names == ENTITIES.elementType.names
    by_column = F.transform(F.array_distinct(F.transform("e", lambda x: x["type"])), lambda t: clean.first_of_any(t, F.filter("e", lambda x: x["type"] == t)))
    rows = df.withColumn("f", in_portions(clean.first_lists, clean.FIRSTS)("e")).select("id", F.transform("f", clean.finished).alias("got"), by_column.alias("want")).collect()
    assert len(rows) == 402 and [r.id for r in rows if r.got != r.want] == []
    assert clean.first_lists(pa.array([], pa.list_(pa.struct([("ord", pa.int64()), ("type", pa.string()), ("text", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())])))).to_pylist() == []


def test_first_spans_are_those_of_all_entities(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    labeler = HashLabeler(["O", "B-name", "I-name", "B-address", "I-notes", "B-gender"])
    e = docs.select("doc_id", entity_spans(F.col("text"), "doc_id", labeler).alias("e"), first_spans(F.col("text"), "doc_id", labeler).alias("f"))
    rows = e.select(F.col("f").alias("got"), in_portions(clean.first_lists, clean.FIRSTS)("e").alias("want")).collect()
    assert all(r.got == r.want for r in rows) and any(r.got for r in rows)


def test_detected_records_take_entities_trimmed_in_python(spark):
    """Trimming every entity in Spark's interpreted expressions was most of the query's time."""
    plan = facade_queries.extract_detected_type(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "locate(" not in plan and "translate(" not in plan
