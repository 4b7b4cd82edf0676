import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from quillspark.llm import neardup
from quillspark.llm.textgrid import grid_of

SCHEMA = "doc_id long, text string, junk string"


def brute_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k=5, percent=80):
    sets = [(d, brute_set(t, k)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = {}
    for d, s in sets:
        for g in s:
            index.setdefault(g, []).append(d)
    by = dict(sets)
    for d, s in sets:
        for e, both in Counter(e for g in s for e in index[g] if e < d).items():
            if 100 * both >= percent * (len(s) + len(by[e]) - both):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets)


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for k in (4, 5):
        assert got(neardup.near_duplicates(docs, k=k)) == brute(rows, k)


def test_chains_of_near_copies(spark):
    rnd = random.Random(5)
    rows, doc = [], 0
    for _ in range(6):
        words = [f"W{rnd.randrange(9999)}" for _ in range(80)]
        for _ in range(rnd.randrange(1, 25)):
            words[rnd.randrange(80)] = f"w{rnd.randrange(9999)}"
            rows.append((doc, " ".join(words)))
            doc += 1
    rows += [(1000 + i, t) for i, t in enumerate([None, "", " \n", "one", "ONE", "one two", "a b c d", "a b c d", "x " * 5000])]
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], SCHEMA)
    assert got(neardup.near_duplicates(df, k=4)) == brute(rows, 4)


def test_null_ids_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e f", None), (3, "a b c d e f", "q"), (3, "a b c d e f", "q"), (1, "a b c d e f", "q")], SCHEMA)
    out = sorted(map(tuple, neardup.near_duplicates(df, k=4).collect()), key=str)
    assert out == [(1, 3, 1, True), (3, 3, 1, False), (3, 3, 1, False), (None, 3, None, True)]
    assert neardup.near_duplicates(df.where("doc_id > 9")).collect() == []


def test_sketch_fills_and_estimates(spark):
    a = " ".join(f"w{i}" for i in range(1000))
    b = " ".join(f"w{i}" for i in range(250, 1250))
    values, at = neardup.shingle_sets(grid_of(pa.array([a, b, "lone", None])), 4)
    bins = neardup.sketch(values, at)
    assert (bins[:3] != neardup.EMPTY).all() and (bins[3] == neardup.EMPTY).all()
    assert abs((bins[0] == bins[1]).mean() - 0.6) < 0.15
    assert np.array_equal(bins, neardup.sketch(values.copy(), at))


def test_one_large_family(spark):
    """Copies at every distance from one text, some linked only by way of others."""
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for d in range(150):
        words = list(rows[rnd.randrange(len(rows))][1].split()) if rows and d % 5 == 0 else list(base)
        for _ in range(rnd.randrange(12)):
            at = rnd.randrange(len(words))
            if rnd.random() < 0.5:
                del words[at]
            else:
                words[at] = f"x{rnd.randrange(9)}"
        rows.append((d, " ".join(words)))
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], SCHEMA)
    want = brute(rows, 4)
    assert len({c for _, _, c, _ in want}) > 3
    assert got(neardup.near_duplicates(df, k=4)) == want


def test_parts_of_one_long_text(spark):
    """Members that lie wholly inside a longer reference: linked by what they share with it alone."""
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(240)]
    rows = [(0, " ".join(base))]
    for d in range(1, 90):
        a = rnd.randrange(100)
        rows.append((d, " ".join(base[a : a + rnd.randrange(70, 230)])))
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], SCHEMA)
    want = brute(rows, 4)
    assert len({c for _, _, c, _ in want}) > 1
    assert got(neardup.near_duplicates(df, k=4)) == want


def test_possible_pairs_miss_no_link(spark):
    """Members of one reference, all taken as unlinked: every true link is among the pairs left to compare."""
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    rows = [(0, base)]
    for d in range(1, 60):
        a = rnd.randrange(110)
        words = base[a : a + rnd.randrange(60, 90)] + [f"x{rnd.randrange(40)}" for _ in range(rnd.randrange(25))]
        rows.append((d, words))
    texts = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "node long, text string")
    pairs = spark.createDataFrame([(0, d, d) for d, _ in rows[1:]], "a long, b long, c long")
    measured = neardup.measure(pairs, texts, 4, 80, rest=True)
    found = {tuple(r) for r in neardup.possible_pairs(measured, texts, 4, 80).collect()}
    sets = {d: brute_set(" ".join(w), 4) for d, w in rows}
    links = {(a, b) for a in sets for b in sets if 0 < a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert links and links <= found and len(found) < 59 * 58 // 2


def test_keep_one_keeps_rows_and_columns(spark):
    schema = "doc_id long, text string, kept string, row int"
    long = " ".join(f"w{i}" for i in range(60))
    near = long + " tail"
    rows = [(None, long, "n", 1), (None, long, "n", 1), (7, long, "a", 2), (7, long, "a", 2), (3, near, "b", 3), (3, long, "c", 4), (3, "other words that stand alone here", "d", 5), (5, "", "e", 6), (5, "", "e", 6), (6, None, "f", 7)]
    docs = spark.createDataFrame(rows, schema)
    out = sorted(map(tuple, neardup.keep_one(docs).collect()), key=str)
    group = [r for r in out if r in ((3, near, "b", 3), (3, long, "c", 4))]
    assert len(group) == 1
    assert sorted([r for r in out if r not in group], key=str) == sorted([rows[0], rows[1], rows[6], rows[7], rows[8], rows[9]], key=str)
    assert neardup.keep_one(docs).schema.names == docs.columns
    assert neardup.keep_one(docs.where("false")).collect() == []
