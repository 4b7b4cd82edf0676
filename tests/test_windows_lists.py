import random

import pyarrow as pa
import pytest

from quillspark.operators import windows

KIND = pa.list_(pa.struct([("win", pa.int64()), ("start", pa.int64()), ("labels", pa.list_(pa.string())), ("confs", pa.list_(pa.float64()))]))


def made(seed):
    rnd = random.Random(seed)
    docs = []
    for n in [0, 1, 7, 20, 33, 12]:
        own = [{"win": w, "start": 5 * w, "labels": (k := [rnd.choice(["O", "B-a", "I-a"]) for _ in range(5 * w, min(5 * w + 12, n))]), "confs": [rnd.randrange(8) / 8 for _ in k]} for w in range(0, max(1, n // 5)) if rnd.random() < 0.8]
        docs.append((n, own))
    return docs


def test_documents_merged_on_their_row_are_as_merged_by_rows(spark):
    docs = made(2)
    rows = [(i, x["start"] + j, x["win"], label, conf) for i, (_, own) in enumerate(docs) for x in own for j, (label, conf) in enumerate(zip(x["labels"], x["confs"]))]
    merged = windows.merge_overlaps(spark.createDataFrame(rows, "d long, pos long, win long, label string, conf double"), "d")
    want = {(r.d, r.pos): (r.label, r.conf) for r in windows.fill_gaps(merged, spark.createDataFrame([(i, n) for i, (n, _) in enumerate(docs)], "d long, n long"), "n", "d").collect()}
    got = windows.merge_lists(pa.array([own for _, own in docs], KIND), pa.array([n for n, _ in docs]))
    assert {(i, p): (x["label"], x["conf"]) for i, own in enumerate(got.to_pylist()) for p, x in enumerate(own)} == want
    part = windows.merge_lists(pa.array([own for _, own in docs], KIND).slice(3, 2), pa.array([n for n, _ in docs]).slice(3, 2))
    assert part.to_pylist() == got.to_pylist()[3:5]


def test_words_of_places():
    places = pa.array([[{"label": "B-a", "conf": 0.5}, {"label": "O", "conf": 1.0}, {"label": "I-a", "conf": 0.25}], []], pa.list_(pa.struct([("label", pa.string()), ("conf", pa.float64())])))
    got = windows.word_lists(places, pa.array([[2, 0, 1], [0]])).to_pylist()
    assert [[tuple(x.values()) for x in own] for own in got] == [[("B-a", 0.75), ("O", 0.0), ("I-a", 0.25)], [("O", 0.0)]]
    with pytest.raises(ValueError):
        windows.word_lists(places, pa.array([[2], [0]]))


def test_gaps_are_not_filled_by_broadcast(spark):
    """Spark counts the exploded places as the few documents they come from."""
    lengths = spark.createDataFrame([(1, 50)], "d long, n long")
    merged = spark.createDataFrame([(1, 3, "B-a", 0.5)], "d long, pos long, label string, conf double")
    plan = windows.fill_gaps(merged, lengths, "n", "d")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
