"""The tagger counted and served on the document's row."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from quillspark.operators import windows
from quillspark.operators.labeler import BatchLabeler, TaggerWeights
from quillspark.plans import flows
from quillspark.plans.predict import encode_subwords, label_counts, served_counts
from tests.conftest import SF


def test_serving_moves_and_explodes_nothing(spark):
    plan = flows.model_serving(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_served_as_by_rows(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}té Xy" for i in range(40))), (2, ""), (3, None), (4, "one"), (4, "日本語x two\nThree  t")], "doc_id long, text string")
    labels = ["O", "B-name", "I-name"]
    model = TaggerWeights(labels, np.random.default_rng(3).normal(size=(7, 3)))
    got = sorted(tuple(r) for r in served_counts(docs, flows._encode_all, BatchLabeler(model, 10, 3), content=10, step=4).collect())
    rows = encode_subwords(docs.withColumn("k", F.monotonically_increasing_id()), lambda t: [ord(t[i]) % 101 for i in range(0, len(t), 3)], "k").join(docs.withColumn("k", F.monotonically_increasing_id()), "k")
    wins = windows.window_spans(rows.withColumn("n", F.size("ids").cast("long")), "n", 10, 4)
    wins = wins.select("k", "doc_id", "n", "win", "start", F.slice("ids", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")).alias("ids"))
    merged = windows.merge_overlaps(BatchLabeler(model, 10, 3).label_windows(wins, "k", "doc_id", "n"), "k", "doc_id", "n")
    want = merged.groupBy("k", "doc_id", "n").agg(F.array(*(F.count_if(F.col("label") == x) for x in labels)).alias("counts"), F.min("conf"), F.max("conf")).drop("k")
    assert [r[0] for r in got] == [1, 4, 4] and sum(r[1] for r in got) == sum(sum(r[2]) for r in got)
    same = lambda rows: [(r[0], r[1], list(r[2]), round(r[3], 9), round(r[4], 9)) for r in rows]
    assert same(got) == same(sorted(tuple(r) for r in want.collect()))


def test_sub_words_counted_in_parts(spark):
    docs = spark.createDataFrame([("Ann tea ann Ann",), ("tea é",), (None,)], "text string").repartition(3)
    got = {(r.id, r.label): r.n for r in label_counts(docs, flows._encode_all, flows._first_letters).groupBy("id", "label").agg(F.sum("n").alias("n")).collect()}
    assert got == {(ord("A"), "B-name"): 2, (ord("t") % 101, "I-name"): 2, (ord("a"), "O"): 1, (ord("é") % 101, "O"): 1}


def test_merge_by_table_and_by_sorting_agree():
    rng = np.random.default_rng(5)
    counts = np.array([0, 1, 9, 40, 23])
    row, win, start, lengths = windows.window_bounds(counts, 10, 4)
    code, conf = rng.integers(0, 3, int(lengths.sum())), rng.integers(0, 4, int(lengths.sum())) / 4
    few = windows.merge_codes(counts, row, win, start, lengths, code, conf, 4)
    many = windows.merge_codes(counts, row, win, start, lengths, code, conf, windows.FEW_LABELS + 1)
    assert (few[0] == many[0]).all() and (few[1] == many[1]).all()


def test_tokens_encoded_at_once():
    tokens = pa.array(["", "a", "abcd", "日本語x", "é"]).slice(1)
    assert flows._encode_all(tokens).to_pylist() == [[ord(t[i]) % 101 for i in range(0, len(t), 3)] for t in tokens.to_pylist()]
    assert pc.equal(flows._first_letters(pa.array(["Zed", "tt", "Éa", "x"])), pa.array(["B-name", "I-name", "O", "O"])).to_pylist() == [True] * 4
