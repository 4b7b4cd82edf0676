import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quillspark.llm import periods
from quillspark.llm.textgrid import grid_of

SCHEMA = "doc_id long, text string, runs string"


def brute_runs(words, least=12):
    out = set()
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                length = j - i + q
                if not any(s <= i and i + length <= s + m and p < q for s, m, p in out if q % p == 0):
                    out.add((i, length, q))
            i = j + 1
    return sorted(r for r in out if r[1] >= max(least, 2 * r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def found(texts, least=12):
    grid = grid_of(pa.array(texts))
    word, length, period = periods.grid_runs(grid, least)
    out = [[] for _ in texts]
    for w, m, q in zip(word.tolist(), length.tolist(), period.tolist()):
        t = int(grid.text[w])
        out[t].append((w - int(grid.first[t]), m, q))
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_random_words_of_few_kinds(letters):
    rnd = random.Random(letters)
    texts = [" ".join(rnd.choice("abcde"[:letters]) for _ in range(rnd.randrange(0, 120))) for _ in range(150)]
    assert found(texts) == [brute_runs(t.split()) for t in texts]
    assert found(texts, 2) == [brute_runs(t.split(), 2) for t in texts]


def test_fibonacci_thue_morse_powers_and_edges():
    fib = ["a", "b"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    morse = "".join(str(bin(i).count("1") % 2) for i in range(300))
    power = ("ab" * 7 + "c") * 9
    cut = "abcdef" * 2  # exactly twice, twelve words
    texts = [" ".join(x) for x in (fib[-1], morse, power, "a" * 500, cut, "x" + cut + "y", "abcdefabcdeg", "aabb" * 3 + "zz" + "aabb" * 3)] + ["", "one", None]
    assert found(texts) == [brute_runs((t or "").split()) for t in texts]


def test_nested_and_planted_runs_in_prose():
    rnd = random.Random(4)
    texts = []
    for _ in range(40):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(20, 300))]
        for _ in range(3):
            at, q = rnd.randrange(len(words)), rnd.randrange(1, 15)
            part = (words[at : at + q] or ["v"]) * rnd.randrange(2, 6)
            words[at:at] = part[: rnd.randrange(len(part) // 2, len(part) + 1)]
        texts.append(" ".join(words))
    assert found(texts) == [brute_runs(t.split()) for t in texts]
    assert found(texts[::-1]) == [brute_runs(t.split()) for t in texts[::-1]]


def test_roots_that_are_powers_are_told(spark):
    f = periods.Factors(np.array([90, *[1, 2] * 30, *[5] * 31, 91]))
    start, k = np.array([1, 1, 1, 61, 61]), np.array([2, 4, 30, 1, 15])
    assert periods.primitive(f, start, k).tolist() == [True, False, False, True, False]


def test_query_rows_against_brute_force(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(0, 90)))) for i in range(400)]
    rows += [(None, "a b " * 20), (7, None), (7, ""), (7, " \n\t"), (8, "é ü\x0bé ü " * 9), (9, "x y z " * 11), (10, "ab " * 3000), (10, "ab " * 3000)]
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], SCHEMA)
    out = periods.run_report(periods.with_periodic_tail(df)).drop("n_words")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((brute_row(*r) for r in rows), key=repr)
    assert periods.run_report(periods.with_periodic_tail(df.where("doc_id > 99999"))).collect() == []


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 4000")
    out = periods.run_report(periods.with_periodic_tail(docs)).drop("n_words")
    want = sorted((brute_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert sorted(map(tuple, out.collect()), key=repr) == want
    assert sum(r[1] > 0 for r in want) > 5


def test_operator_gives_runs_and_text(spark):
    df = spark.createDataFrame([(1, "p q r " + "a b " * 6 + "s", None)], SCHEMA)
    row = periods.find_runs(df).first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (16, [(3, 12, 2)], "p q r a b s")
