import hashlib
import random
import re

import pytest

from quillspark.llm import repeats, spread

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    lowest = {}
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[i : i + window])
                lowest[key] = min(d, lowest.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and lowest[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(repeats.remove_repeats(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def planted(seed):
    rnd = random.Random(seed)
    passages = [[f"p{rnd.randrange(50)}" for _ in range(rnd.choice((12, 13, 14, 30)))] for _ in range(12)]
    rows = [(i, t) for i, t in enumerate([None, "", " ", "a " * 12, "a " * 13, "a\n" * 13, "b " * 40])]
    for d in range(10, 150):
        words = []
        for _ in range(rnd.randrange(6)):
            words += rnd.choice(passages) if rnd.random() < 0.5 else [f"w{rnd.randrange(20)}é" for _ in range(rnd.randrange(20))]
        rows.append((d, rnd.choice((" ", "  ", "\n\t")).join(words)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [13, 26, 5])
def test_planted(spark, window):
    rows = planted(window)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_words int, d1 string")
    assert got(repeats.remove_repeats(df, window)) == brute(rows, window)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text), (4, text), (4, text), (2, text + " tail"), (None, None), (9, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(repeats.remove_repeats(df)) == brute(rows)
    assert got(repeats.remove_repeats(df.where("false"))) == []


def test_levels_double_until_none_survives(spark):
    shared = {n: " ".join(f"s{n}x{i}" for i in range(n)) for n in (13, 30, 110)}
    rows = [(1, "a b " + shared[13]), (2, shared[13] + " c"), (3, shared[30] + " d"), (4, "e " + shared[30]), (5, shared[110]), (6, shared[110] + " f"), (7, "lonely " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.level for r in repeats.repeat_levels(df).collect()} == {1: 13, 2: 13, 3: 26, 4: 26, 5: 104, 6: 104}


def test_hot_passage_and_very_long_text(spark, monkeypatch):
    """A passage that most documents share, split over salts; a text of very many words."""
    monkeypatch.setattr(spread, "HEAVY_ROWS", 20)
    rnd = random.Random(8)
    hot = [f"h{i}" for i in range(20)]
    rows = [(d, " ".join([f"a{rnd.randrange(10**6)}" for _ in range(5)] + hot * (d % 3 > 0) + [f"b{rnd.randrange(10**6)}"] * 2)) for d in range(400)]
    rows.append((1000, " ".join(f"c{i % 7001}" for i in range(60_000)) + " " + " ".join(hot)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(repeats.remove_repeats(df)) == brute(rows)
