"""Whitening of embeddings over an exact scatter matrix in residue numbers.

1. Components c become integers x = floor(scale * c); the fit list holds every
   distinct x vector once.
2. One aggregate gives the number of vectors and the largest |x|, and with them a
   bound on every sum of products. As many primes below 2^22 are taken as their
   product needs to tell all values within the bound apart.
3. Each partition reduces its vectors (with a leading 1, so that counts and sums
   are products too) modulo each prime and multiplies them, 512 rows at a time,
   in doubles: 512 * (2^22)^2 < 2^53, so every modular product is exact. What a
   partition sends is its upper triangle per prime; Spark adds those up.
4. Chinese remaindering gives back the integers n, S and X'X; the covariance is
   (n * X'X - S S') / n^2, integers until the one division, which rounds correctly.
5. A double eigendecomposition gives the components; each row is centred in
   integers (n * x - S) and projected.

The driver holds dim^2 numbers per prime, whatever the rows. The scatter, the
deviation and n do not depend on the partitioning.

Nulls and odd rows: vectors that are null or hold a null or non-finite component
take no part, in the fit or in the result; a null vec_id and repeated rows keep
their rows; shorter vectors count as padded with zeros; x and deviations past the
range of long count as the range's end; a component with no variance (an
eigenvalue that is rounding error next to the largest) has no whitened value
(null) and stays out of ``identity_error``, which is null if none is left; vectors
without components give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import settle
from .workers import turn_to

SCALE = 256
COMPONENTS = 4
PRIME_BITS = 22
GEMM_ROWS = 512  # times 2^44 is 2^53
LONG = np.iinfo(np.int64)


def primes_for(bound: int) -> list[int]:
    """The largest primes below 2^22 whose product exceeds ``2 * bound``, so that values from -bound to bound differ."""
    out, p = [], 1 << PRIME_BITS
    while prod(out) <= 2 * bound:
        p -= 1
        while any(p % d == 0 for d in range(2, int(p**0.5) + 1)):
            p -= 1
        out.append(p)
    return out


def recombined(residues: dict[int, int]) -> int:
    """The integer nearest to zero with these residues: {prime: residue}."""
    whole = prod(residues)
    value = sum(r * (whole // p) * pow(whole // p, -1, p) for p, r in residues.items()) % whole
    return value - whole if 2 * value > whole else value


def modular_gram(x: np.ndarray, p: int) -> np.ndarray:
    """x'x modulo p for integers in [0, p), by exact products of doubles."""
    out = np.zeros((x.shape[1], x.shape[1]), np.int64)
    for a in range(0, len(x), GEMM_ROWS):
        part = x[a : a + GEMM_ROWS].astype(np.float64)
        out = (out + (part.T @ part).astype(np.int64) % p) % p
    return out


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as int64, all of ``dim`` components."""
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


def scatter_residues(dim: int, primes: list[int]):
    """prime, i, j, residue of a partition's sums of products of (1, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to("whiten")
        sums = {p: np.zeros((dim + 1, dim + 1), np.int64) for p in primes}
        for batch in batches:
            x = matrix(batch.column("x"), dim)
            for p in primes:
                sums[p] = (sums[p] + modular_gram(np.concatenate((np.ones((len(x), 1), np.int64), x % p), axis=1), p)) % p
        i, j = np.triu_indices(dim + 1)
        for p in primes:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), p)), pa.array(i), pa.array(j), pa.array(sums[p][i, j])], names=["prime", "i", "j", "residue"])

    return run


def usable(c: Column) -> Column:
    each = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return c.isNotNull() & F.coalesce(each, F.lit(False))


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(usable(F.col("v")))
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(scale * x).cast("long")).alias("x"))


class Whitening:
    """n, S and the exact scatter of a fit list, and the components of its covariance."""

    def __init__(self, n: int, sums: list[int], products: list[list[int]], components: int) -> None:
        self.n, self.sums, self.products, dim = n, sums, products, len(sums)
        self.covariance = np.array([[(n * products[i][j] - sums[i] * sums[j]) / n**2 for j in range(dim)] for i in range(dim)])
        trace = sum(n * products[i][i] - sums[i] ** 2 for i in range(dim)) / n**2
        values, axes = np.linalg.eigh(self.covariance)
        first = np.argsort(-values, kind="stable")[:components]
        self.values, self.axes = values[first], axes[:, first]
        self.axes = self.axes * np.sign(self.axes[np.abs(self.axes).argmax(axis=0), np.arange(len(first))])
        self.real = self.values > max(values.max(initial=0), 0) * dim * np.finfo(np.float64).eps
        self.explained = self.values / trace if trace else np.full(len(first), np.nan)

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x - S/n in doubles, and the exact sum of (n * x - S)^2 of each row, at most the range of long."""
        most = self.n * int(max(-int(x.min(initial=0)), int(x.max(initial=0)))) + max(map(abs, self.sums), default=0)
        if len(self.sums) * most**2 < LONG.max:
            d = self.n * x - np.array(self.sums, np.int64)
            return d / self.n, (d * d).sum(axis=1)
        d = self.n * x.astype(object) - np.array(self.sums, object)
        return (d / self.n).astype(np.float64), np.array([min(int(s), LONG.max) for s in (d * d).sum(axis=1)], np.int64)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.real, centred @ self.axes / np.sqrt(np.where(self.real, self.values, 1)), np.nan)


def fit_whitening(fit: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a list of distinct vectors (column x, ``dim`` integers each); None for an empty one."""
    ends = fit.agg(F.count("*"), F.max(F.array_max("x")), F.min(F.array_min("x"))).first()
    n = ends[0]
    if not n or not dim:
        return None
    most = max(abs(ends[1]), abs(ends[2]), 1)
    primes = primes_for(n * most**2)
    parts = fit.mapInArrow(scatter_residues(dim, primes), "prime long, i long, j long, residue long")
    residues: dict[tuple[int, int], dict[int, int]] = {}
    for p, i, j, r in parts.groupBy("prime", "i", "j").agg(F.sum("residue").alias("r")).collect():  # dim^2 rows per prime
        residues.setdefault((i, j), {})[p] = r % p
    at = lambda i, j: recombined(residues[min(i, j), max(i, j)])
    assert at(0, 0) == n
    return Whitening(n, [at(0, j) for j in range(1, dim + 1)], [[at(i, j) for j in range(1, dim + 1)] for i in range(1, dim + 1)], components)


def identity_error(fit: DataFrame, dim: int, found: Whitening) -> float | None:
    """The largest entry of the covariance of the fit list's whitened values minus the identity."""
    real = np.flatnonzero(found.real)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to("whiten")
        sums = np.zeros((len(real) + 1, len(real) + 1))
        for batch in batches:
            w = found.whitened(found.centred(matrix(batch.column("x"), dim))[0])[:, real]
            w = np.concatenate((np.ones((len(w), 1)), w), axis=1)
            sums += w.T @ w
        i, j = np.triu_indices(len(real) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(sums[i, j])], names=["i", "j", "s"])

    got = {(i, j): s / found.n for i, j, s in fit.mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s")).collect()}
    errors = [abs(s - got[0, i] * got[0, j] - (i == j)) for (i, j), s in got.items() if i]
    return max(errors, default=None)


WHITE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error per usable row and component."""
    spark = vectors.sparkSession
    rows = quantised(vectors, scale)
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))))
    fit = settle(rows.select("x").distinct())
    found = fit_whitening(fit, dim, components)
    if found is None:
        return spark.createDataFrame([], WHITE)
    error = identity_error(fit, dim, found)
    most = len(found.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to("whiten")
        for batch in batches:
            centred, deviation = found.centred(matrix(batch.column("x"), dim))
            white = found.whitened(centred)
            n = batch.num_rows
            explained = np.tile(found.explained, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.repeat(np.arange(n), most))), pa.array(np.tile(np.arange(1, most + 1, dtype=np.int32), n)), pa.array(np.full(n * most, found.n)), pa.array(np.repeat(deviation, most)),
                 pa.array(white.reshape(-1), mask=np.isnan(white.reshape(-1))), pa.array(explained, mask=np.isnan(explained)), pa.array([error] * (n * most), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, WHITE)
