"""Repeated passages by level-wise doubling, and their removal.

A passage of ``window`` words can repeat only if every shorter piece of it does.
So windows are found level by level: those that repeat at one length alone are
extended to twice that length (the last step is cut to the wanted one), until
the wanted length is reached or no candidate survives. ``repeat_levels`` goes on
doubling past it, until none survives, to tell how long repeats run.

The first level is thinned without losing anything: of the seeds (windows of
half the length) inside each wanted window only the one with the smallest hash
counts, and equal windows agree on it. That leaves about a quarter of all
positions to shuffle. Texts whose whole word sequence is the same form a class;
its smallest document stands for it, and all others are repeats throughout.

A seed or window that very many documents share is split over tasks when its rows
meet their key's verdict.

Seeds are 64-bit hashes: a collision makes a needless candidate, never a result.
The wanted windows are compared by two independent 64-bit hashes.

Nulls and odd rows: a null text has no words; a document with a null doc_id
keeps all its words and removes none elsewhere; rows with the same doc_id never
remove each other's words; extra columns are ignored. Texts of fewer words than
a window stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import spread_join
from .storage import release, settle
from .textgrid import U64, Grid, blocks, grid_of, long_lists, mix, per_text

WINDOW = 13
LEAST_SEED = 6


def lengths(window: int) -> list[int]:
    """Seed length, then doubled lengths up to the window: 13 gives 7, 13."""
    out = [window]
    while out[0] >= 2 * LEAST_SEED:
        out.insert(0, -(-out[0] // 2))
    return out


def sequence_digests(grid: Grid, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each text's word sequence."""
    place = (np.arange(len(hashes)) - grid.first[:-1][grid.text]).astype(U64)
    return tuple(per_text(mix(hashes ^ mix(place * U64(2) + U64(stream))), grid.first, np.add) for stream in (101, 202))


def seeds(grid: Grid, hashes: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts; for each the word at which its seed starts, and the seed's hash."""
    values = np.zeros(len(hashes), U64)
    found, at = grid.windows(hashes, k)
    values[at] = found
    _, starts = grid.windows(hashes, window)
    best, where = values[starts], starts.copy()
    for j in range(1, window - k + 1):
        other = values[starts + j]
        less = other < best
        best[less] = other[less]
        where[less] = starts[less] + j
    return starts, where, best


def joined(grid: Grid, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of all texts, joined by one space within a text, and each text's bounds."""
    start, end, text = grid.start[keep], grid.end[keep], grid.text[keep]
    edges = np.zeros(len(grid.data) + 1, np.int32)
    np.add.at(edges, start, 1)
    np.add.at(edges, end, -1)
    chosen = np.cumsum(edges[:-1]) > 0
    data = grid.data
    gaps = end[:-1][text[:-1] == text[1:]] if len(text) else end
    if len(gaps):
        data = data.copy()
        data[gaps] = 32
        chosen[gaps] = True
    bounds = np.concatenate(([0], np.cumsum(chosen)))[grid.text_at]
    return data[chosen], bounds


def digests(grid: Grid, keep: np.ndarray) -> list[str]:
    data, at = joined(grid, keep)
    view = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at, at[1:])]


PROFILE = "doc_id long, n_words long, d1 long, d2 long, whole_sha256 string, seeds array<long>"


def profile_texts(window: int):
    k = lengths(window)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            grid = grid_of(block.column("text"))
            hashes = grid.word_hashes()
            d1, d2 = sequence_digests(grid, hashes)
            starts, where, best = seeds(grid, hashes, window, k)
            fresh = np.ones(len(where), bool)
            fresh[1:] = where[1:] != where[:-1]
            own = grid.text[starts[fresh]]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(grid.n_words), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(digests(grid, np.ones(len(grid.start), bool))),
                 long_lists(best[fresh], np.searchsorted(own, np.arange(grid.n_texts + 1)))],
                names=["doc_id", "n_words", "d1", "d2", "whole_sha256", "seeds"],
            )

    return run


KEYS = "doc_id long, d1 long, start array<long>, k1 array<long>, k2 array<long>"


def window_keys(window: int, length: int, first: bool):
    """For candidate windows: the starts and keys of the pieces of ``length`` words they consist of.

    ``alive`` holds repeated seeds at the first level, else starts of windows alive.
    Past the wanted length a window is a candidate if both its halves are alive.
    """
    k = lengths(window)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            grid = grid_of(block.column("text"))
            hashes, second = grid.word_hashes(), grid.word_hashes(stream=1)
            same = sequence_digests(grid, hashes)[0].view(np.int64) == np.asarray(block.column("d1"))
            alive = block.column("alive")
            sizes = np.asarray(alive.value_lengths())
            items, owner = np.asarray(alive.flatten()), np.repeat(np.arange(len(alive)), sizes)
            if first:
                starts, _, best = seeds(grid, hashes, window, k)
                text = grid.text[starts]
                tag = mix(best ^ mix(text.astype(U64)))
                wanted = np.sort(mix(items.view(U64) ^ mix(owner.astype(U64))))
                at = starts[_among(tag, wanted)]
            else:
                at = grid.first[owner] + items
                if length > window:
                    at = np.sort(at)
                    at = at[_among(at + length // 2, at)]
            at = at[same[grid.text[at]]] if len(at) else at
            if length < window:
                at = np.unique((at[:, None] + np.arange(window - length + 1)).reshape(-1))
            k1, spots = grid.windows(hashes, length)
            k2, _ = grid.windows(second, length)
            pick = np.searchsorted(spots, at)
            fits = (pick < len(spots)) & (spots[np.minimum(pick, max(len(spots) - 1, 0))] == at) if len(spots) else np.zeros(len(at), bool)
            at, pick = at[fits], pick[fits]
            order = np.argsort(at, kind="stable")
            at, pick = at[order], pick[order]
            bounds = np.searchsorted(grid.text[at], np.arange(grid.n_texts + 1))
            local = (at - grid.first[:-1][grid.text[at]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("d1"), long_lists(local, bounds), long_lists(k1[pick], bounds), long_lists(k2[pick], bounds)], names=["doc_id", "d1", "start", "k1", "k2"])

    return run


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def survivors(window: int, length: int):
    """From repeated piece starts to starts of windows all of whose pieces repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in batch.column("start"):
                at = np.unique(np.asarray(found.values))
                for _ in range(window - length):
                    at = at[_among(at + 1, at)]
                out.append(at)
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("d1"), long_lists(np.concatenate([*out, np.zeros(0, np.int64)]), bounds)], names=["doc_id", "d1", "alive"])

    return run


def drop_words(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            grid = grid_of(block.column("text"))
            gone = np.zeros(len(grid.start), bool)
            marks = block.column("marks")
            at = grid.first[np.repeat(np.arange(len(marks)), np.asarray(marks.value_lengths()))] + np.asarray(marks.flatten())
            for j in range(window):
                gone[at + j] = True
            n = np.bincount(grid.text[gone], minlength=grid.n_texts)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("d1"), pa.array(n.astype(np.int64)), pa.array(digests(grid, ~gone))], names=["doc_id", "d1", "n_removed", "kept_sha256"])

    return run


def _profiled(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """docs (doc_id, text), profile, class representatives, texts of documents with a repeated seed."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = settle(docs.mapInArrow(profile_texts(window), PROFILE))
    full = profile.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    reps = settle(full.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    seen = full.select("d1", F.explode("seeds").alias("seed"))
    repeated = settle(seen.groupBy("seed").agg(F.min("d1").alias("low"), F.max("d1").alias("high"), F.count("*").alias("n")).where("low <> high").select("seed", "n"))
    release(docs.sparkSession)
    owners = spread_join(full.select("doc_id", "d1", F.explode("seeds").alias("seed")), repeated, ["seed"], "n", ["doc_id", "d1"])
    alive = owners.groupBy("doc_id", "d1").agg(F.collect_set("seed").alias("alive")).join(reps.select(F.col("rep").alias("doc_id"), "d1"), ["doc_id", "d1"], "left_semi")
    alive = settle(alive)
    release(docs.sparkSession)
    profile = settle(profile.drop("seeds"))
    del full, seen, owners, repeated
    release(docs.sparkSession)
    texts = settle(docs.join(alive, "doc_id"))
    del alive
    release(docs.sparkSession)
    return docs, profile, reps, texts


def _level(texts: DataFrame, window: int, length: int, first: bool) -> DataFrame:
    """(doc_id, d1, start, low) of the pieces of this length that repeat across documents."""
    keys = texts.mapInArrow(window_keys(window, length, first), KEYS)  # made twice: cheaper than keeping them
    rows = keys.select("doc_id", "d1", F.explode(F.arrays_zip("start", "k1", "k2")).alias("x")).select("doc_id", "d1", "x.start", "x.k1", "x.k2")
    shared = rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).where("low <> high")
    shared = settle(shared.select("k1", "k2", "low", "n"))
    release(texts.sparkSession)
    return spread_join(rows, shared, ["k1", "k2"], "n", ["doc_id", "start"])


def _grown(texts: DataFrame, found: DataFrame, window: int, length: int) -> DataFrame:
    """The texts again, ``alive`` now the starts of windows that survive this level."""
    starts = found.groupBy("doc_id", "d1").agg(F.collect_list("start").alias("start"))
    alive = starts.mapInArrow(survivors(max(window, length), length), "doc_id long, d1 long, alive array<long>").where(F.size("alive") > 0)
    return settle(texts.drop("alive").join(alive, ["doc_id", "d1"]))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per document.

    A word goes if some window over it also starts in a document with a smaller
    doc_id; windows are judged on the input, not on what is left.
    """
    _, profile, reps, texts = _profiled(docs, window)
    steps = lengths(window)[1:] or [window]
    for i, length in enumerate(steps):
        found = _level(texts, window, length, first=i == 0)
        if length < window:
            texts = _grown(texts, found, window, length)
    marks = found.where("doc_id > low").groupBy("doc_id", "d1").agg(F.collect_list("start").alias("marks"))
    touched = settle(texts.drop("alive").join(marks, ["doc_id", "d1"]).mapInArrow(drop_words(window), "doc_id long, d1 long, n_removed long, kept_sha256 string"))
    release(docs.sparkSession)
    judged = (F.col("n_words") >= window) & F.col("doc_id").isNotNull()
    # only classes of several documents are looked up, the large ones by many tasks; what has no class is dealt evenly
    rows = profile.select("doc_id", "n_words", F.when(judged, F.col("d1")).otherwise(F.xxhash64("doc_id", "d1")).alias("c1"), F.when(judged, F.col("d2")).alias("c2"), "d1", "whole_sha256")
    several = reps.where("copies > 1").select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), "rep", "copies")
    rows = spread_join(rows, several, ["c1", "c2"], "copies", ["doc_id"], "left").join(touched.distinct(), ["doc_id", "d1"], "left")
    copy = judged & F.coalesce(F.col("doc_id") != F.col("rep"), F.lit(False))
    return rows.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )


def repeat_levels(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, level: the longest of window, 2 * window, 4 * window, ... words at which the document
    (the smallest of its class) still shares a passage with another class; documents with none are left out."""
    _, _, _, texts = _profiled(docs, window)
    steps, level, first, out = lengths(window)[1:] or [window], 0, True, None
    while True:
        length = steps.pop(0) if steps else 2 * level
        found = _level(texts, window, length, first)
        texts, first, level = _grown(texts, found, window, length), False, length
        here = texts.select("doc_id", F.lit(length).alias("level")) if length >= window else None
        if here is not None:
            out = here if out is None else out.union(here)
        if texts.isEmpty():
            return (out if out is not None else texts.select("doc_id", F.lit(0).alias("level"))).groupBy("doc_id").agg(F.max("level").alias("level"))
