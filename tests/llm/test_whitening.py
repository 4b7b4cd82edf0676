import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int"


def brute(rows):
    """n, deviations by row and (vec_id, whitened, explained) from exact fractions."""
    rows = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in rows})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dim)]
    cov = np.array([[float(sum((Fraction(x[i]) - Fraction(sums[i], n)) * (Fraction(x[j]) - Fraction(sums[j], n)) for x in fit) / n) for j in range(dim)] for i in range(dim)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    out = []
    for i, x in rows:
        d = np.array([float(Fraction(x[j]) - Fraction(sums[j], n)) for j in range(dim)])
        out.append((i, n, sum((n * x[j] - sums[j]) ** 2 for j in range(dim)), d @ axes / np.sqrt(values), values / values.sum()))
    return out


def compare(got, want, components):
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), []).append(r)
    assert sum(map(len, by.values())) == len(want) * components
    for i, n, deviation, white, explained in want:
        own = sorted(by[i, deviation], key=lambda r: r.component)
        assert all(r.n == n and r.identity_error < 1e-9 for r in own)
        for c in range(components):
            mine = [r for r in own if r.component == c + 1]
            assert len(mine) and all(abs(abs(r.whitened) - abs(white[c])) < 1e-6 and abs(r.explained - explained[c]) < 1e-9 for r in mine)


def test_small_tables_against_fractions(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, d + 1) for d in range(6)]) for i in range(60)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6), (103, [float("inf")] * 6), (5, rows[5][1]), (None, rows[7][1])]
    df = spark.createDataFrame([(i, v, None, "q", 3) for i, v in rows], SCHEMA)
    got = whitening.whiten(df).collect()
    own = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    compare(got, brute(own), 4)
    assert len({r.n for r in got}) == 1 and got[0].n == 60


def test_embeddings_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", F.slice("embedding", 1, 8).alias("embedding"))
    compare(whitening.whiten(df).collect(), brute([tuple(r) for r in df.collect()]), 4)


def test_huge_components_are_exact(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.uniform(-1, 1) * 2.0**40, rnd.uniform(0, 1) * 2.0**30, 1.5]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = whitening.quantised(df, 256).select("x")
    found = whitening.fit_whitening(x, 3)
    own = [[int(np.floor(256 * c)) for c in v] for _, v in rows]
    assert found.sums == [sum(v[d] for v in own) for d in range(3)]
    assert found.products == [[sum(v[i] * v[j] for v in own) for j in range(3)] for i in range(3)]
    assert found.real.tolist() == [True, True, False]
    got = whitening.whiten(df).collect()
    assert all((r.whitened is None) == (r.component == 3) and r.deviation == whitening.LONG.max for r in got)


def test_few_rows_and_dimensions(spark):
    df = spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0])], "vec_id long, embedding array<float>")
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in whitening.whiten(df).orderBy("vec_id", "component").collect()] == [(c, 1, 0, None, None, None) for c in (1, 2, 1, 2)]
    assert whitening.whiten(df.where("vec_id > 9")).collect() == []
    short = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, [])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id, r.n) for r in whitening.whiten(short).where("component = 1").collect()) == [(1, 2), (2, 2), (3, 2)]


@pytest.mark.parametrize("value", [0, 1, -1, 10**30, -(10**30), 123456789012345678901234567890])
def test_residues_give_the_integer_back(value):
    primes = whitening.primes_for(10**30)
    assert whitening.recombined({p: value % p for p in primes}) == value


def test_modular_products_stay_exact():
    rnd = np.random.default_rng(0)
    p = whitening.primes_for(1)[0]
    x = rnd.integers(p - 50, p, (1500, 5))
    want = np.array([[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) % p for j in range(5)] for i in range(5)])
    assert (whitening.modular_gram(x, p) == want).all()
