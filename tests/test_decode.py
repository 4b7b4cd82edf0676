import random
from decimal import ROUND_HALF_UP, Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.functions.text import uniform
from quillspark.operators import decode, labeler
from quillspark.operators.tokens import token_lists

KIND = pa.list_(pa.struct([("token", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("conf", pa.float64())]))


def brute(tokens, value_only):
    out, now = [], None
    for t in tokens or ():
        label = t["label"]
        if label is None:
            continue
        prefix, dash, name = label.partition("-")
        if label == "O" or not dash or (value_only and "_VALUE" not in label):
            now = None
        elif prefix in ("B", "I"):
            kind = name.replace("_VALUE", "").upper()
            if prefix == "B" or now is None or now[0] != kind:
                now = (kind, f"B-{name}", [])
                out.append(now)
            now[2].append(t)
    mean = lambda own: None if any(t["conf"] is None for t in own) else float(Decimal(repr(sum(t["conf"] for t in own) / len(own))).quantize(Decimal("0.0001"), ROUND_HALF_UP))
    return [{"ord": i + 1, "type": k, "text": " ".join(t["token"] for t in own if t["token"] is not None), "start": own[0]["start"], "end": own[-1]["end"], "label": b, "confidence": mean(own)} for i, (k, b, own) in enumerate(out)]


@pytest.mark.parametrize("value_only", [False, True])
def test_spans_of_many_lists_at_once(value_only):
    rnd = random.Random(5)
    labels = ["O", "B-a", "I-a", "I-a_VALUE", "B-b_VALUE", "I-b_VALUE", "S-a", "bad", None, "close-a", "B-"]
    made = lambda i: {"token": None if rnd.random() < 0.05 else f"t{i}", "start": 2 * i, "end": 2 * i + 1, "label": rnd.choice(labels), "conf": None if rnd.random() < 0.02 else rnd.randrange(64) / 64}
    rows = [None if rnd.random() < 0.1 else [made(i) for i in range(rnd.randrange(30))] for _ in range(300)]
    whole = pa.array(rows, KIND)
    for part, want in ((whole, rows), (whole.slice(7, 40), rows[7:47]), (whole.slice(0, 0), [])):
        assert decode.span_lists(part, value_only).to_pylist() == [None if r is None else brute(r, value_only) for r in want]


def test_halves_are_rounded_as_spark_rounds(spark):
    values = [0.03125, 0.28125, 0.33335, 1.00005, 0.00005, 0.12344999999, 1 / 3, -0.03125]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").coalesce(1).select(F.round("x", 4)).collect()]
    assert decode.rounded(pa.array(values).to_numpy()).tolist() == want


def test_hashed_labels_are_those_of_the_expression(spark):
    own = labeler.HashLabeler(["O", "B-a", "I-a"])
    df = spark.createDataFrame([(3, "a b c d e f g"), (None, "x y"), (4, None)], "id long, text string").coalesce(1)
    want = {(r.id, r.i): (own.labels[int(r.u * 3)], int(r.v * 64) / 64) for r in df.select("id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("i")).select("id", "i", uniform(42, F.col("id"), F.col("i"), "label").alias("u"), uniform(42, F.col("id"), F.col("i"), "conf").alias("v")).collect()}
    lists = own.label_lists(token_lists(pa.array(["a b c d e f g", "x y", None])), pa.array(["3", None, "4"])).to_pylist()
    assert [(t["label"], t["conf"]) for t in lists[0]] == [want[3, i] for i in range(7)] and [(t["label"], t["conf"]) for t in lists[1]] == [want[None, i] for i in range(2)]
    spans = {r.id: r.e for r in df.select("id", labeler.entity_spans(F.col("text"), "id", own).alias("e")).collect()}
    apart = {r.id: r.e for r in df.select("id", F.col("text")).select("id", decode.decoded_spans(own.label_array(labeler.tokens_with_offsets("text"), "id")).alias("e")).collect()}
    assert spans == apart
