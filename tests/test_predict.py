"""The model plan with a mock tokenizer (a sub-word per character) and a mock model (labels by character)."""

from quillspark.operators.labeler import ModelLabeler
from quillspark.plans.predict import encode_subwords, predict


def encode(token):
    return [] if token == "?" else [ord(c) for c in token]


def load():
    names = {ord("N"): "B-name", ord("M"): "I-name", ord("A"): "B-address_VALUE"}
    return lambda batch: [([names.get(i, "O") for i in ids], [0.5 if i == ord("N") else 1.0 for i in ids]) for ids in batch]


def test_predict_over_windows(spark):
    long = "x " * 300 + "Nab Mcd ? Aef " + "y " * 300
    docs = spark.createDataFrame([(1, long), (2, ""), (3, "Nn"), (4, "?")], "doc_id long, text string")
    sub = {r.doc_id: r for r in encode_subwords(docs, encode).collect()}
    assert sub[4].sizes == [0] and len(sub[1].ids) == 609 and sub[2].ids == []
    got = sorted(tuple(r) for r in predict(docs, encode, ModelLabeler(load), content=20, step=10).collect())
    assert [(d, t, x, s, e) for d, _, t, x, s, e, _, _ in got] == [(1, "NAME", "Nab Mcd", 600, 607), (1, "ADDRESS", "Aef", 610, 613), (3, "NAME", "Nn", 0, 2)]
    assert got[0][7] == round(((0.5 + 1 + 1) / 3 + 1) / 2, 4)
