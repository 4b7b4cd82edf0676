import random
from itertools import combinations

import numpy as np

from quillspark.llm import combos
from tests.llm.test_neardup import SCHEMA, brute


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def want(rows):
    return [r[:3] for r in brute(rows, 5)]


def test_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(combos.similar_documents(docs)) == want(rows)


def test_families_with_every_token_frequent(spark):
    rnd = random.Random(5)
    rows, doc = [], 0
    for size in (30, 90, 400):
        base = [f"W{rnd.randrange(9999)}" for _ in range(size)]
        for _ in range(60):
            words = list(base)
            for _ in range(rnd.randrange(1, 2 + size // 12)):
                words[rnd.randrange(size)] = f"w{rnd.randrange(9)}"
            del words[: rnd.randrange(size // 10)]
            rows.append((doc, " ".join(words)))
            doc += 1
    rows += [(1000 + i, t) for i, t in enumerate([None, "", " \n", "one", "ONE", "one two", "a b c d", "a b c d", "a b c d e f", "x " * 5000])]
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], SCHEMA)
    assert len({c for _, _, c in want(rows)}) > 10
    for frequent in (2, 10_000):
        assert got(combos.similar_documents(df, frequent=frequent)) == want(rows)
    assert got(combos.similar_documents(df, frequent=4, k=3)) == want(rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e f", None), (3, "a b c d e f", "q"), (3, "a b c d e f", "q"), (1, "a b c d e f", "q")], SCHEMA)
    assert sorted(map(tuple, combos.similar_documents(df).collect()), key=str) == [(1, 2, 1), (3, 2, 1), (3, 2, 1), (None, 2, None)]
    assert combos.similar_documents(df.where("doc_id > 9")).collect() == []


def test_combinations_of_groups():
    group = np.array([0, 0, 0, 1, 2, 2, 2, 2])
    for k in (1, 2, 3):
        rows = sorted(zip(*(c.tolist() for c in combos.combinations(group, k))))
        assert rows == sorted(c for c in combinations(range(8), k) if len({int(group[i]) for i in c}) == 1)
    assert combos.combinations(group[:0], 2)[0].tolist() == []


def test_linked_sets_always_share_a_signature():
    """Pairs right at the threshold, of any size, with any tokens frequent."""
    rnd = random.Random(7)
    for turn in range(1500):
        k, n = rnd.choice((1, 2, 2, 3)), rnd.randrange(1, 1500 if turn % 5 == 0 else 60)
        universe = rnd.sample(range(1, 1 << 62), 3 * n)
        both = universe[:n]
        extra = max(0, (20 * n) // 80 - rnd.choice((0, 0, 1)))
        own = rnd.randint(0, extra)
        x, y = sorted(both + universe[n : n + own]), sorted(both + universe[n + own : n + extra])
        assert 100 * n >= 80 * (len(x) + len(y) - n)
        share = rnd.choice((0.0, 0.5, 0.9, 1.0))
        often = {t: combos.FREQUENT if rnd.random() < share else 2 for t in universe}
        parts = []
        for s in (x, y):
            size = np.array([len(s)])
            parts.append(s[: int(combos.prefix_length(size, combos.level_of(size), 80)[0])])
        found = []
        for s, part, other in ((x, *parts), (y, *parts[::-1])):
            size = np.array([len(s)])
            # tokens of the other set's prefix, and some that third sets have
            rows = [(i, t) for i, t in enumerate(part) if t in other or rnd.random() < 0.3]
            mine = set()
            for level in {int(combos.level_of(size)[0]), int(combos.level_of(combos.smallest_partner(size, 80))[0])}:
                args = (np.zeros(len(rows), np.int64), np.array([i for i, _ in rows], np.int64), np.array([t for _, t in rows], np.uint64), np.array([often[t] for _, t in rows], np.int64))
                mine |= set(combos.signatures(size, np.array([level]), *args, 80, k)[1].tolist())
            found.append(mine)
        assert found[0] & found[1], (turn, n, k, share)
