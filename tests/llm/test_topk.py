import random

import duckdb
import numpy as np

from quillspark.llm import topk


def brute(rows, every=50, k=5):
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(good):
        if i % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(good) if b != a)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def test_embeddings_and_sql(spark):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    df = spark.read.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = sorted(con.execute(topk.TOP_SQL).fetchall())
    assert got(topk.top_products(df)) == want == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_blocks_ties_and_odd_vectors(spark, monkeypatch):
    for name, n in (("QUERY_ROWS", 3), ("BLOCK_BYTES", 400), ("CHUNK", 16), ("SEED_ROWS", 12)):
        monkeypatch.setattr(topk, name, n)
    rnd = random.Random(1)
    rows = [(i, [float(rnd.choice([-1, 0, 0.5, 1])) for _ in range(rnd.choice([8, 8, 5]))]) for i in range(150)]
    rows += [(200, None), (210, []), (202, [None, 1.0]), (250, [float("nan"), 1.0]), (203, [float("inf")]), (None, [1.0])]
    rows += [(50, rows[50][1]), (50, rows[50][1]), (7, rows[7][1])]  # repeated rows, queries and others
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, v int, row int")
    pad = [(i, v + [0.0] * (8 - len(v)) if v is not None and None not in v else v) for i, v in rows]
    assert got(topk.top_products(df, every=10)) == brute(pad, every=10)
    assert got(topk.top_products(df.where("false"))) == []
    few = df.where("vec_id in (50, 1, 2)")
    assert got(topk.top_products(few)) == brute([r for r in pad if r[0] in (50, 1, 2)])


def test_sql_counts_repeated_rows_and_empty_vectors(spark, tmp_path):
    rows = [(i, [0.25 * i, 1.0, -0.5]) for i in (50, 50, 1, 2, 4, 100)] + [(3, []), (5, None), (6, [None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df.write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    assert sorted(con.execute(topk.TOP_SQL).fetchall()) == got(topk.top_products(df)) == brute([(i, v or [0.0] * 3 if v == [] else v) for i, v in rows])


def test_pruning_is_exact_and_prunes():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 32)) * 300
    x = np.floor(centres[rng.integers(0, 9, 5000)] + rng.normal(size=(5000, 32)) * 40)
    ids, rows = rng.permutation(5000), np.arange(5000)
    found = topk.Search(rows[:60], x[:60], 5)
    found.seed(rows[::50], x[::50])
    for at in range(0, 5000, 700):
        found.show(rows[at : at + 700], ids[at : at + 700], x[at : at + 700])
    scores = x[:60] @ x.T
    for i in range(60):
        want = [j for _, j in sorted((-s, j) for r, (s, j) in enumerate(zip(scores[i], ids)) if r != i)[:5]]
        assert [w for _, w in found.best[i]] == want
    assert found.seen[0] == 60 * 4999 and found.seen[-1] < 0.2 * found.seen[0]


def test_pruning_on_documents_embeddings(spark):
    report = {r.segments: r.pairs for r in topk.pruning_report(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")).collect()}
    print(report)
    assert report[-1] < 0.8 * report[0]


def test_huge_components():
    x = np.array([[1e12, 1.0], [2e12, 0.0], [1.0, 5.0]])
    found = topk.Search(np.array([0]), x[:1], 2)
    found.show(np.arange(3), np.arange(3), x)
    assert found.best == [[(-(2**63 - 1), 1), (-(10**12 + 5), 2)]]
