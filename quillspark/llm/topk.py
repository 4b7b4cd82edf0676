"""Exact top-k inner products with multi-resolution segment statistics.

A vector is cut into segments; each segment keeps its mean and deviation. Over
segments of length m, <q, x> <= sum m * (mean_q * mean_x + dev_q * dev_x) by
Cauchy-Schwarz on what is left after the means; with |q|^2 and |x|^2 fixed this
upper bound on the product is the lower bound on the distance. Segments are
halved from one down to pairs of components (each refinement only tightens the
bound): a candidate that cannot reach the query's k-th best score so far at some
resolution goes no further, and exact integer products are computed for the
survivors only. How much each resolution prunes depends on the data;
``pruning_report`` counts it.

So that bounds have something to prune against from the start, every query first
meets ``SEED_ROWS`` candidates of largest norm; its k-th best score among them is
a floor below which no candidate counts. Candidates come in order of falling norm.

Queries are broadcast in blocks of at most ``BLOCK_BYTES``; the candidates stay
where they are, and each task keeps the k best of every query over all its
candidates. So no candidate is shuffled, memory is bounded whatever the table,
and tasks return k rows per query, which are cut to the k best.

Components x become floor(scale * x). Vectors that are null or hold a null or
non-finite component, and rows without a vec_id, take no part. Shorter vectors
count as padded with zeros, an empty one as zeros throughout. Every row whose
vec_id is divisible is a query of its own and meets every row but itself, rows
of its own vec_id included. Components so large that products would pass 2^53
are computed in Python integers; a score past the range of long counts as the
range's end, in ranking too. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import settle
from .workers import turn_to

K = 5
SCALE = 256
QUERY_EVERY = 50
BLOCK_BYTES = 16 << 20
QUERY_ROWS = 2048
CHUNK = 1024
SEED_ROWS = 512
PAIRS = 16384
LONG = np.iinfo(np.int64)


def quantise(scale: int):
    """Usable rows with their vectors as integers and their norms; a bad vector's row goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to("topk")
        for batch in batches:
            ids, out = [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
                if i is None or v is None or any(x is None for x in v):
                    continue
                v = np.asarray(v, np.float64)
                if np.isfinite(v).all():
                    ids.append(i)
                    out.append(np.floor(scale * np.clip(v, -1e300, 1e300)))  # beyond, every score but 0 is out of range anyway
            norms = [float(np.sqrt(np.minimum(np.square(v).sum(), 1e300))) for v in out]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.float64())), pa.array(norms, pa.float64())], names=["vec_id", "v", "norm"])

    return run


def as_matrix(rows: list, dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def resolutions(dim: int) -> list[int]:
    """Numbers of segments from one up to pairs of components."""
    out = [1]
    while 4 * out[-1] <= dim:
        out.append(2 * out[-1])
    return out


def statistics(m: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: sqrt(length) * mean and sqrt(length) * deviation of each segment."""
    parts = np.array_split(m, segments, axis=1)
    root = np.sqrt([p.shape[1] for p in parts])
    return np.stack([p.mean(axis=1) for p in parts], 1) * root, np.stack([p.std(axis=1) for p in parts], 1) * root


def exact(q: np.ndarray, x: np.ndarray) -> int:
    return max(LONG.min, min(LONG.max, sum(int(a) * int(b) for a, b in zip(q, x))))


class Search:
    """The k best candidates of each query of a block, over all candidates shown so far."""

    def __init__(self, rows: np.ndarray, q: np.ndarray, k: int) -> None:
        self.rows, self.q, self.k = rows, q, k
        self.floor = np.full(len(q), -np.inf)
        self.best: list[list[tuple[int, int]]] = [[] for _ in rows]  # (-score, vec_id), ascending
        self.levels = resolutions(q.shape[1]) if q.shape[1] else []
        self.stats = [statistics(q, s) for s in self.levels]
        self.seen = np.zeros(len(self.levels) + 2, np.int64)  # pairs shown, left after each resolution, computed exactly

    def seed(self, rows: np.ndarray, x: np.ndarray) -> None:
        """The k-th best score among some candidates is a floor for the k-th best of all."""
        if len(x) > self.k and not self.too_large(x):
            for a in range(0, len(self.q), QUERY_ROWS):
                scores = self.q[a : a + QUERY_ROWS] @ x.T
                scores[self.rows[a : a + QUERY_ROWS, None] == rows[None, :]] = -np.inf
                self.floor[a : a + QUERY_ROWS] = np.partition(scores, -self.k, axis=1)[:, -self.k]

    def too_large(self, x: np.ndarray) -> bool:
        return float(np.abs(self.q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1]) >= 2.0**53

    def offer(self, i: int, found: list[tuple[int, int]]) -> None:
        mine = sorted(self.best[i] + found)[: self.k]
        self.best[i] = mine
        if len(mine) == self.k:
            self.floor[i] = max(self.floor[i], -mine[-1][0])

    def show(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        if self.too_large(x):
            for i, a in enumerate(self.q):
                self.offer(i, [(-exact(a, b), int(v)) for b, v, r in zip(x, ids, rows) if r != self.rows[i]])
            return
        stats = [statistics(x, s) for s in self.levels]
        for a in range(0, len(self.q), QUERY_ROWS):
            part = slice(a, a + QUERY_ROWS)
            left = self.rows[part, None] != rows[None, :]
            self.seen[0] += left.sum()
            floor = self.floor[part, None]
            for n, ((mean, dev), (x_mean, x_dev)) in enumerate(zip(self.stats, stats)):
                if not left.any():
                    break
                mean, dev = mean[part], dev[part]
                left &= mean @ x_mean.T + dev @ x_dev.T + (1e-9 * (np.abs(mean) @ np.abs(x_mean).T + dev @ x_dev.T) + 1e-6) >= floor
                self.seen[n + 1] += left.sum()
            i, j = np.nonzero(left)
            self.seen[-1] += len(i)
            if not len(i):
                continue
            q = self.q[part]
            scores = np.concatenate([np.einsum("ij,ij->i", q[i[b : b + PAIRS]], x[j[b : b + PAIRS]]) for b in range(0, len(i), PAIRS)])
            good = scores >= floor[i, 0]
            i, j, scores = i[good], j[good], scores[good]
            order = np.lexsort((ids[j], -scores, i))
            i, j, scores = i[order], j[order], scores[order]
            few = np.arange(len(i)) - np.searchsorted(i, i) < self.k
            for u, v, s in zip(i[few].tolist(), ids[j[few]].tolist(), scores[few].tolist()):
                mine = self.best[a + u]
                if len(mine) < self.k or (-s, v) < mine[-1]:
                    self.offer(a + u, [(-int(s), v)])


def _blocks(vectors: DataFrame, every: int, k: int, scale: int):
    """Per block of queries: the candidates, and what a task does with them."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(quantise(scale), "vec_id long, v array<double>, norm double")
    # numbered once, in what is written
    rows = settle(rows.sortWithinPartitions(F.desc("norm"), "vec_id").select("*", F.monotonically_increasing_id().alias("row")))
    query = rows.where((F.col("vec_id") % every) == 0)
    dim, n = rows.agg(F.max(F.size("v"))).first()[0] or 0, query.count()
    blocks = -(-n * 8 * max(dim, 1) // BLOCK_BYTES)
    seeds = rows.orderBy(F.desc("norm"), "row").limit(SEED_ROWS).select("row", "v").collect()
    seed = np.array([r.row for r in seeds], np.int64), as_matrix([r.v for r in seeds], dim)
    for b in range(blocks):
        block = query.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "vec_id", "v").collect()
        own = np.array([r.row for r in block], np.int64), np.array([r.vec_id for r in block], np.int64), as_matrix([r.v for r in block], dim)
        shared = vectors.sparkSession.sparkContext.broadcast((own, seed))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> tuple[Search, np.ndarray]:
            turn_to("topk")
            (number, ids, q), (seed_rows, seed_x) = shared.value
            found = Search(number, q, k)
            found.seed(seed_rows, seed_x)
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(at, CHUNK)
                    found.show(np.asarray(part.column("row")), np.asarray(part.column("vec_id")), as_matrix(part.column("v").to_pylist(), q.shape[1]))
            return found, ids

        yield rows.select("row", "vec_id", "v"), search


def _every_block(parts: list[DataFrame], vectors: DataFrame, schema: str) -> DataFrame:
    out = vectors.sparkSession.createDataFrame([], schema)
    for part in parts:
        out = out.union(part)
    return out


def top_products(vectors: DataFrame, every: int = QUERY_EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row whose vec_id is divisible by ``every``."""
    schema, parts = "query_row long, query_id long, vec_id long, score long", []
    for candidates, search in _blocks(vectors, every, k, scale):

        def run(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            found, ids = search(batches)
            rows = [(int(r), int(i), v, -s) for r, i, best in zip(found.rows, ids, found.best) for s, v in best]
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], pa.int64()) for c in range(4)], names=["query_row", "query_id", "vec_id", "score"])

        parts.append(candidates.mapInArrow(run, schema))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = _every_block(parts, vectors, schema).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def pruning_report(vectors: DataFrame, every: int = QUERY_EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """segments (0: all pairs, -1: computed exactly), pairs: how many (query, candidate) pairs are left after each resolution."""
    schema, parts = "segments long, pairs long", []
    for candidates, search in _blocks(vectors, every, k, scale):

        def run(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            found, _ = search(batches)
            yield pa.RecordBatch.from_arrays([pa.array([0, *found.levels, -1], pa.int64()), pa.array(found.seen)], names=["segments", "pairs"])

        parts.append(candidates.mapInArrow(run, schema))
    return _every_block(parts, vectors, schema).groupBy("segments").agg(F.sum("pairs").alias("pairs"))


TOP_SQL = f"""
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)
), scored AS (
  SELECT q.r, q.vec_id AS query_id, x.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.v, x.v, true), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM usable q JOIN usable x ON q.r <> x.r WHERE q.vec_id % {QUERY_EVERY} = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= {K}
"""
