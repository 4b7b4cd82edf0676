import random
import tracemalloc

import numpy as np
import pyarrow as pa

from quillspark.operators import detect, metrics


def test_counts_on_the_row_are_those_of_rows(spark):
    rnd = random.Random(4)
    tags = ["O", "O", "B-a", "I-a", "B-b", "I-b"]
    gold = [[rnd.choice(tags) for _ in range(rnd.randrange(15))] for _ in range(60)]
    predicted = [["O" if rnd.random() < 0.2 else t for t in own] for own in gold]
    frame = lambda lists: spark.createDataFrame([(d, i, t) for d, own in enumerate(lists) for i, t in enumerate(own)], "d long, tok_idx long, label string")
    want = {r.type: (r.tp, r.n_pred, r.n_gold) for r in metrics.entity_scores(frame(gold), frame(predicted), "d").collect() if r.type}
    kind = pa.list_(pa.string())
    got = metrics.count_lists(pa.array([[], *gold], kind).slice(1), pa.array(predicted, kind)).to_pylist()
    assert len(got) == len(gold)
    assert {t: tuple(sum(x[c] for own in got for x in own if x["type"] == t) for c in ("tp", "n_pred", "n_gold")) for t in ("a", "b")} == want


def test_products_at_once_are_bounded():
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(size=(3000, 8)), 2)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(3000)), pa.array(list(v))], names=["id", "v"])
    ids = np.arange(0, 3000, 2)
    tracemalloc.start()
    best, who = detect.nearest(iter([batch]), ids, v[ids], 3)
    assert tracemalloc.get_traced_memory()[1] < 40 << 20
    tracemalloc.stop()
    scores = np.round(v[ids] @ v.T, 6)
    scores[np.arange(len(ids)), ids] = -np.inf
    order = np.lexsort((np.broadcast_to(np.arange(3000), scores.shape), -scores), axis=1)[:, :3]
    assert (who == order).all() and (best == np.take_along_axis(scores, order, 1)).all()
