"""Large JSON arrays read by many tasks: one file is cut on the borders of its records.

Spark's own reader of multi-line JSON gives a whole file to one task. Here the
file is read as text split at closing braces, so that Spark deals it out by byte
ranges, wherever its file systems reach. Whether a brace closes a record depends on
what lies before it: inside a string or not, and how deep. So there are two passes:

1. Every byte range is scanned for both beginnings (inside a string or not) and
   tells how the state and the depth change, and how many braces close at each
   depth relative to its first. That is two small rows per range, of which Spark
   itself keeps as many on the driver.
2. With these folded per file, every range knows its state, its depth and the
   number of its first record, and gives out the records that lie in it as they
   are. Records across a border come as pieces, are put together by number, and
   are the only rows that are shuffled.

Records are objects; anything else between them is an error. Backslashes and
braces in strings, nested objects, blanks and line ends are all right. An empty
array and an empty file have no records. Bytes are looked at in stretches of at most
``MOST_BYTES``, so only a record itself, not a batch or range, has to fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.portions import MOST_BYTES, portions, weights

QUOTE, BACKSLASH, OPEN, CLOSE, OPEN_LIST, CLOSE_LIST = (ord(c) for c in '"\\{}[]')


def unescaped_quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that begin or end a string: an even number of backslashes before them."""
    quotes = data == QUOTE
    slashes = data == BACKSLASH
    if slashes.any():
        at = np.arange(len(data))
        last = np.maximum.accumulate(np.where(slashes, -1, at))  # the last byte that is no backslash
        run = np.concatenate(([0], (at - last)[:-1]))
        quotes &= run % 2 == 0
    return quotes


def scan(data: np.ndarray, inside: bool) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether the end lies inside a string; the depth after every byte relative to the start; which bytes are braces that close."""
    parity = (np.cumsum(unescaped_quotes(data)) + inside) % 2 == 1
    out = ~parity
    steps = np.zeros(len(data), np.int64)
    steps[out & ((data == OPEN) | (data == OPEN_LIST))] = 1
    steps[out & ((data == CLOSE) | (data == CLOSE_LIST))] = -1
    return bool(parity[-1]) if len(data) else inside, np.cumsum(steps), out & (data == CLOSE)


def stretches(data: bytes, most: int = MOST_BYTES) -> Iterator[bytes]:
    """``data`` in parts of about ``most``; none but the last ends with a backslash, whose effect would be lost."""
    at = 0
    while len(data) - at > most:
        end = at + most
        while end < len(data) and data[end - 1] == BACKSLASH:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, np.ndarray]]:
    """(path, start of the byte range, bytes) of consecutive rows of one range, the braces they were split at put back.

    A file's very last row, which no brace ends, gets one too many: a brace after the array has depth -1 and closes nothing.
    """
    for batch in batches:
        paths, starts = batch.column("path"), np.asarray(batch.column("block"))
        edges = np.flatnonzero(np.diff(starts) != 0) + 1 if len(starts) else []
        names = paths.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(starts) else np.zeros(0)
        cuts = sorted({0, *np.asarray(edges).tolist(), *(np.flatnonzero(np.diff(names) != 0) + 1).tolist(), len(starts)})
        for a, b in zip(cuts, cuts[1:]):
            own = batch.column("value").slice(a, b - a)
            for at, n in portions(weights(own)):
                text = "}".join(own.slice(at, n).to_pylist()) + "}"
                for part in stretches(text.encode()):
                    yield paths[a].as_py(), int(starts[a]), np.frombuffer(part, np.uint8)


SUMMARY = "path string, block long, inside boolean, ends_inside boolean, depth long, closed map<long,long>"


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each beginning of every byte range, its stretches folded."""
    types = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.map_(pa.int64(), pa.int64()))

    def told(range_: tuple[str, int], found: dict[bool, tuple[bool, int, dict[int, int]]]) -> pa.RecordBatch:
        rows = [(*range_, inside, ends, depth, sorted(closed.items())) for inside, (ends, depth, closed) in found.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[x.split()[0] for x in SUMMARY.split(", ")])

    here, found = None, {}
    for path, block, data in pieces(batches):
        if (path, block) != here:
            if here is not None:
                yield told(here, found)
            here, found = (path, block), {inside: (inside, 0, {}) for inside in (False, True)}
        scanned = {inside: scan(data, inside) for inside in {ends for ends, _, _ in found.values()}}
        for inside, (state, before, closed) in found.items():
            ends, depth, close = scanned[state]
            levels, counts = np.unique(depth[close], return_counts=True)
            for level, n in zip((levels + before).tolist(), counts.tolist()):
                closed[level] = closed.get(level, 0) + n
            found[inside] = ends, before + (int(depth[-1]) if len(depth) else 0), closed
    if here is not None:
        yield told(here, found)


def states(rows: list) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """(inside a string, depth, records before) at the start of every (path, byte range), from its summaries."""
    by: dict[tuple[str, int], dict[bool, tuple]] = {}
    for r in rows:
        by.setdefault((r.path, r.block), {})[r.inside] = (r.ends_inside, r.depth, r.closed)
    out: dict[tuple[str, int], tuple[bool, int, int]] = {}
    file, state = None, (False, 0, 0)
    for path, block in sorted(by):
        if path != file:
            file, state = path, (False, 0, 0)
        out[path, block] = state
        inside, depth, number = state
        ends, change, closed = by[path, block][inside]
        state = ends, depth + change, number + closed.get(1 - depth, 0)
    return out


PIECE = "path string, number long, block long, seq long, value string, whole boolean"


def cut(known: dict[tuple[str, int], tuple[bool, int, int]]):
    """Records that lie whole in a range, and the pieces of those that do not."""

    def rows_of(range_: tuple[str, int], seq: int, number: int, text: bytes, whole: bool) -> tuple:
        return (range_[0], number, range_[1], seq, text.decode(), whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, carry, state, first = None, b"", (False, 0, 0), True

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[x.split()[0] for x in PIECE.split(", ")])

        for path, block, data in pieces(batches):
            out = []
            if (path, block) != here:
                if here is not None and carry.strip():
                    out.append(rows_of(here, 1, state[2], carry, False))
                here, carry, state = (path, block), b"", known[path, block]
                first = state[1] > 1  # the range begins inside a record
            inside, depth, number = state
            ends, steps, close = scan(data, inside)
            at = np.flatnonzero(close & (depth + steps == 1)) + 1
            raw = data.tobytes()
            for a, b in zip([0, *at[:-1].tolist()], at.tolist()):
                out.append(rows_of(here, 0, number, carry + raw[a:b], not first))
                carry, first, number = b"", False, number + 1
            carry += raw[int(at[-1]) if len(at) else 0 :]
            state = ends, depth + int(steps[-1]), number
            if out:
                yield batch_of(out)
        if here is not None and carry.strip():
            yield batch_of([rows_of(here, 1, state[2], carry, False)])

    return run


def read_json_array(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """The records of one or more files that hold a JSON array of objects each, with ``path`` and ``number`` (from 0 in each file)."""
    text = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    known = states(text.mapInArrow(summaries, SUMMARY).collect())  # two rows for every byte range
    found = text.mapInArrow(cut(known), PIECE)
    # what is no whole record is null before it is parsed: Spark may put a filter on parsed fields before these
    whole = found.select("path", "number", F.when(F.col("whole"), F.col("value")).alias("value")).where("value IS NOT NULL")
    parts = found.where("NOT whole").groupBy("path", "number").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "value"))).alias("p"))
    joined = parts.select("path", "number", F.array_join(F.transform("p", lambda x: x["value"]), "").alias("value"))
    # before a record stands what separates it from the one before: [ or a comma and blanks
    bare = F.regexp_replace("value", r"^[\[,\s]+", "")
    rows = whole.unionByName(joined).withColumn("value", bare)
    rows = rows.withColumn("value", F.when(F.startswith("value", F.lit("{")), F.col("value"))).where("value IS NOT NULL")
    return rows.select("path", "number", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("path", "number", "r.*")


def write_json_array(rows: DataFrame, path: str) -> None:
    """One file with a JSON array of objects for every partition of ``rows``."""
    lines = rows.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns))).alias("value"))

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opened = None, False  # the last row waits, for it has no comma after it
        for batch in batches:
            for at, n in portions(weights(batch.column("value"))):
                values = [x for x in (held, *batch.column("value").slice(at, n).to_pylist()) if x is not None]
                if not values:
                    continue
                *done, held = values
                if done:
                    done = [x + "," for x in done]
                    if not opened:
                        done[0], opened = "[" + done[0], True
                    yield pa.RecordBatch.from_arrays([pa.array(done)], names=["value"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([("" if opened else "[") + held + "]"])], names=["value"])

    lines.mapInArrow(framed, "value string").write.mode("overwrite").text(path)

