import random
import re
from itertools import product

import numpy as np

from quillspark.llm import mixing, spread


def brute_targets(sizes, weights=(5, 2, 1), share=1.5):
    """Repeated resharing, word for word."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, budget, free = {}, share * sum(sizes.values()), set(names)
    while free:
        rate = budget / sum(w[s] for s in free)
        over = {s for s in free if w[s] * rate > 2 * sizes[s]}
        if not over:
            target |= {s: w[s] * rate for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        budget -= sum(2 * sizes[s] for s in over)
        free -= over
    return target


def check(rows, out):
    sizes = {}
    size_of = {}
    for d, s, t in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] = sizes.get(s, 0) + n
        size_of[d] = (s, n)
    target, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    assert len(out) == len(rows)
    for r in out:
        s, n = size_of[r.doc_id]
        assert r["size"] == n and r.source_size == sizes[s]
        assert abs(r.target - target[s]) <= 1e-6 * max(1, target[s])
        assert r.taken in (0, n, 2 * n)
        taken[s] += r.taken
    for s in sizes:
        longest = max(n for x, n in size_of.values() if x == s)
        assert target[s] - max(longest, 1) <= taken[s] <= target[s] + 1e-6, (s, taken[s], target[s])
    return target, taken


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    out = mixing.mix_documents(docs).collect()
    target, taken = check(rows, out)
    assert all(abs(target[s] - taken[s]) <= 2 for s in target)  # lengths are varied enough for a close fit
    again = mixing.mix_documents(docs.repartition(5)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_random_sources_with_nulls(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    rnd = random.Random(4)
    for turn in range(3):
        rows = [(d, rnd.choice([None, "a", "b", "é", "zz", "", "null"][: 3 + 2 * turn]), rnd.choice([None, "", "x", "x y", "q " * rnd.randrange(40)])) for d in range(300)]
        docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, source string, text string, size int, target string")
        check(rows, mixing.mix_documents(docs).collect())
    empty = docs.where("false")
    assert mixing.mix_documents(empty).collect() == []


def test_single_length_group(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    rows = [(d, "s" if d % 3 else "t", "one two three") for d in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    check(rows, mixing.mix_documents(docs).collect())


def test_knapsack_is_exact():
    rnd = random.Random(8)
    for _ in range(200):
        k = rnd.randrange(1, 5)
        sizes = np.array(rnd.sample(range(1, 12), k))
        counts = np.array([rnd.randrange(1, 4) for _ in range(k)])
        budget = rnd.randrange(0, int((sizes * counts).sum()) + 2)
        take = mixing.fit_counts(sizes, counts, budget, 1)
        assert (take >= 0).all() and (take <= counts).all() and (take * sizes).sum() <= budget
        base = np.array([int(c) * budget // int((sizes * counts).sum()) for c in counts])
        sums = [sum(c * s for c, s in zip(x, sizes)) for x in product(*(range(min(b, c), c + 1) for b, c in zip(base, counts)))]
        assert (take * sizes).sum() == max(s for s in sums if s <= budget)


def test_rows_come_as_often_as_taken(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice([None, 1, 2, 3, d]), rnd.choice([None, "a", "b", "c"]), rnd.choice([None, "", "x", "x y", "q r s " * rnd.randrange(1, 9)]), d % 3) for d in range(200)]
    rows += rows[:40]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copies int")
    out = list(map(tuple, mixing.repeat_taken(docs).collect()))
    sizes, taken = {}, {}
    words = lambda t: len((t or "").split())
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    for _, s, t, _ in out:
        taken[s] = taken.get(s, 0) + words(t)
    for s, target in brute_targets(sizes).items():
        assert target - max(words(r[2]) for r in rows if r[1] == s) <= taken[s] <= target + 1e-6
    have = {r: rows.count(r) for r in rows}
    assert all(out.count(r) <= 2 * n for r, n in have.items()) and set(out) <= set(have)
    assert mixing.repeat_taken(docs).schema.names == docs.columns and mixing.repeat_taken(docs.where("false")).collect() == []


def test_a_split_length_gives_the_same_mix(spark, monkeypatch):
    """A length that a third of all rows share is met by many tasks, with the same result."""
    rows = [(i, "one two three", "a") for i in range(100)] + [(1000 + i, "w " * (1 + i % 40), "ab"[i % 2]) for i in range(200)] + [(None, "one two three", "a"), (7, "one two three", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    whole = sorted(map(tuple, mixing.mix_documents(docs).collect()), key=str)
    monkeypatch.setattr(spread, "HEAVY_ROWS", 10)
    assert sorted(map(tuple, mixing.mix_documents(docs).collect()), key=str) == whole and len(whole) == len(rows)
