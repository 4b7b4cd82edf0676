"""Periodic runs of words by the linear tandem-repeat method of Gusfield and Stoye.

A run is a stretch of words with smallest period q (words q apart are identical),
at least ``least`` words and two periods long, that no neighbouring word extends.

Per block of texts, on the words of one concatenated string whose texts are kept
apart by marks that occur once:

1. Words that no run can hold go first. In a run of 12 or more words every word
   lies in a window of 6 words that occurs twice in its text, so only stretches
   of such words (12 or more) are looked at; nothing else is cut or capped.
2. Ranks of all substrings of 1, 2, 4, ... words give the suffix array and answer
   longest common extensions both ways in a few look-ups. The suffix tree is used
   as the intervals of the suffix array.
3. Lempel-Ziv blocks: each begins where the longest part with an earlier
   occurrence ends. Around each block's borders two families of extensions
   (Gusfield and Stoye's algorithms 1A and 1B) yield squares that cover the
   leftmost occurrence of every distinct square. Only squares of a primitive
   root go on: their periods are the smallest periods of runs, and a covering
   square and what it covers are rotations of each other.
4. From each covering square a walk of suffix links, each followed by the letter
   dropped, goes on to the next rotation as long as that is a square in the text;
   it ends after a whole turn. The loci met, counted once, are the vocabulary of
   squares with a primitive root.
5. The suffix array's interval under each locus holds all occurrences of its
   square. Occurrences of one period at consecutive words merge into runs.

Steps 3 to 5 take time linear in the words and in the occurrences of primitive
squares, which are O(n log n); the ranks take O(n log n).

Words are compared by two independent 64-bit hashes of their bytes.

Nulls and odd rows: a null or empty text has no words and no run; null and
repeated doc_ids keep their rows (a null one has no ``with_periodic_tail``);
extra columns are ignored; a text is never cut, and a long one is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import joined
from .textgrid import U64, Grid, blocks, grid_of, mix

LEAST = 12
WORD = r"[^\x20\x09-\x0D]+"


def dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


class Factors:
    """Ranks of the substrings of 1, 2, 4, ... letters of a string whose first and last letters occur once."""

    def __init__(self, letters: np.ndarray) -> None:
        self.n = n = len(letters)
        rank, self.levels = dense(letters), []
        while True:
            self.levels.append(rank.astype(np.int32))
            step = 1 << (len(self.levels) - 1)
            if int(rank.max()) == n - 1:
                break
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            rank = dense(rank * (n + 1) + after)
        self.place = rank
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many letters from i and from j (different places) on are the same."""
        i, j = i.copy(), j.copy()
        at = i.copy()
        for k in range(len(self.levels) - 2, -1, -1):
            rank = self.levels[k]
            same = rank[i] == rank[j]
            i[same] += 1 << k
            j[same] += 1 << k
        return i - at

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many letters up to and with i and j (different places) are the same."""
        i, j = i.copy(), j.copy()
        at = i.copy()
        for k in range(len(self.levels) - 2, -1, -1):
            rank, back = self.levels[k], (1 << k) - 1
            inside = (i >= back) & (j >= back)
            same = inside & (rank[np.maximum(i - back, 0)] == rank[np.maximum(j - back, 0)])
            i[same] -= 1 << k
            j[same] -= 1 << k
        return at - i


def block_starts(f: Factors) -> np.ndarray:
    """Starts of the Lempel-Ziv blocks, and the end of the string."""
    # the nearest suffixes in order, on either side, that begin earlier
    order = f.order.tolist()
    left, right, stack = [-1] * f.n, [-1] * f.n, []
    for i in order:
        while stack and stack[-1] > i:
            right[stack.pop()] = i
        left[i] = stack[-1] if stack else -1
        stack.append(i)
    longest, at = np.zeros(f.n, np.int64), np.arange(f.n)
    for other in (np.array(left), np.array(right)):
        has = other >= 0
        longest[has] = np.maximum(longest[has], f.forward(at[has], other[has]))
    out, i, steps = [], 0, longest.tolist()
    while i < f.n:
        out.append(i)
        i += steps[i] or 1
    return np.array([*out, f.n])


def upto(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and number from 1 of ``sizes[i]`` rows each."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1


def covering_squares(f: Factors, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, root length) of squares that cover the leftmost occurrence of every distinct square."""
    h, size = starts[:-1], np.diff(starts)
    # 1A: the border after a block, roots up to the block's length
    owner, k = upto(size[:-1])
    border = h[1:][owner]
    q = border - k
    owner, k, border, q = (x[q > 0] for x in (owner, k, border, q))
    ahead, back = f.forward(border, q), f.backward(border - 1, q - 1)
    start = np.maximum(q - back, q - k + 1)
    good = (ahead + back >= k) & (ahead > 0)
    found = [(start[good], k[good])]
    # 1B: the border before a block, roots up to the length of it and the next
    both = size + np.append(size[1:], 0)
    owner, k = upto(both[1:])
    border, after = h[1:][owner], starts[2:][owner]
    q = border + k
    border, after, k, q = (x[q < f.n] for x in (border, after, k, q))
    ahead, back = f.forward(border, q), f.backward(border - 1, q - 1)
    start = np.maximum(border - back, border - k + 1)
    good = (ahead + back >= k) & (ahead > 0) & (back > 0) & (start + k <= after)
    found.append((start[good], k[good]))
    return tuple(np.concatenate(x) for x in zip(*found))


def primitive(f: Factors, start: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Whether the squares' roots are no powers: no k / p, p a prime factor of k, is a period of the square."""
    out, rest, p = np.ones(len(k), bool), k.copy(), 2
    while (rest > 1).any():
        hit = np.flatnonzero(rest % p == 0)
        if len(hit):
            d = k[hit] // p
            out[hit] &= f.forward(start[hit], start[hit] + d) < 2 * k[hit] - d
            while len(hit := np.flatnonzero((rest % p == 0) & (rest > 1))):
                rest[hit] //= p
        p += 1
        if p * p > rest.max(initial=1):  # what is left of each is a prime
            last = np.flatnonzero(rest > 1)
            d = k[last] // rest[last]
            out[last] &= f.forward(start[last], start[last] + d) < 2 * k[last] - d
            break
    return out


class Least:
    """Minima of stretches of an array."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values.astype(np.int32)]
        while 2 << (len(self.levels) - 1) <= len(values):
            row, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(row[:-half], row[half:]))

    def reach(self, at: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and last place of the interval round ``at`` within which neighbours agree in ``least`` letters;
        values[r] is what the suffixes in places r - 1 and r agree in."""
        low, high, n = at.copy(), at.copy(), len(self.levels[0])
        for j in range(len(self.levels) - 1, -1, -1):
            row, size = self.levels[j], 1 << j
            far = low - size + 1
            ok = (far >= 1) & (row[np.clip(far, 0, len(row) - 1)] >= least)
            low[ok] -= size
            ok = (high + size < n) & (row[np.minimum(high + 1, len(row) - 1)] >= least)
            high[ok] += size
        return low, high


def vocabulary(f: Factors, start: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The loci (first and last place in the suffix array, root length) of all squares of the string with these and rotated roots."""
    begin = start - f.backward(start - 1, start + k - 1)  # of the run of period k
    order = np.lexsort((start, begin, k))
    start, begin, k = start[order], begin[order], k[order]
    first = np.ones(len(k), bool)
    first[1:] = (begin[1:] != begin[:-1]) | (k[1:] != k[:-1])
    start, k = start[first], k[first]
    # a suffix link goes from the square at i to that at i + 1; the letter dropped comes next there as long as the period lasts
    turns = np.minimum(k, f.forward(start, start + k) - k + 1)
    owner, number = upto(turns)
    at, k = start[owner] + number - 1, k[owner]
    common = np.zeros(f.n, np.int64)
    common[1:] = f.forward(f.order[:-1], f.order[1:])
    low, high = Least(common).reach(f.place[at], 2 * k)
    once = np.unique(low * (f.n + 1) + k, return_index=True)[1]
    return low[once], high[once], k[once]


def runs_of(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length, smallest period of all runs of a string whose first and last letters occur once."""
    f = Factors(letters)
    start, k = covering_squares(f, block_starts(f))
    good = primitive(f, start, k)
    low, high, k = vocabulary(f, start[good], k[good])
    owner, number = upto(high - low + 1)
    at, k = f.order[low[owner] + number - 1], k[owner]
    order = np.lexsort((at, k))
    at, k = at[order], k[order]
    opens = np.ones(len(at), bool)
    opens[1:] = (k[1:] != k[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return at[first], at[last] - at[first] + 2 * k[first], k[first]


def stretches(grid: Grid, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of the stretches of words that a run of ``least`` words or more can lie in."""
    piece, hashes = least // 2, grid.word_hashes()
    values, at = grid.windows(hashes, piece)
    if not len(values):
        return at, at
    values = mix(values ^ mix(grid.text[at].astype(U64) + U64(1)))
    ordered = np.sort(values)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return at[:0], at[:0]
    hit = at[twice[np.minimum(np.searchsorted(twice, values), len(twice) - 1)] == values]
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, hit, 1)
    np.add.at(edges, hit + piece, -1)
    inside = np.cumsum(edges[:-1]) > 0
    fresh = np.ones(len(hashes) + 1, bool)
    fresh[1:-1] = grid.text[1:] != grid.text[:-1]
    before = np.concatenate(([False], inside[:-1]))
    first = np.flatnonzero(inside & (~before | fresh[:-1]))
    end = np.flatnonzero(inside & (~np.append(inside[1:], False) | fresh[1:])) + 1
    long = end - first >= least
    return first[long], end[long]


def grid_runs(grid: Grid, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """word, length, period of all runs of the block's texts, by word, then period."""
    first, end = stretches(grid, least)
    none = np.zeros(0, np.int64)
    if not len(first):
        return none, none, none
    owner, number = upto(end - first)
    word = first[owner] + number - 1
    one, two = (dense(grid.word_hashes(stream=s)[word]) for s in (0, 1))
    same = dense(one * (int(two.max()) + 1) + two)
    # a mark before each stretch and one after the last
    spot = np.arange(len(word)) + owner + 1
    letters = np.full(len(word) + len(first) + 1, -1, np.int64)
    letters[spot] = same
    marks = np.flatnonzero(letters < 0)
    letters[marks] = len(word) + np.arange(len(marks))
    where = np.full(len(letters), -1, np.int64)
    where[spot] = word
    at, length, period = runs_of(letters)
    long = length >= least
    at, length, period = where[at[long]], length[long], period[long]
    order = np.lexsort((period, at))
    return at[order], length[order], period[order]


RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def collapse(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            grid = grid_of(block.column("text"))
            word, length, period = grid_runs(grid, least)
            edges = np.zeros(len(grid.start) + 1, np.int64)
            np.add.at(edges, word + period, 1)
            np.add.at(edges, word + length, -1)
            data, at = joined(grid, np.cumsum(edges[:-1]) == 0)
            text = grid.text[word]
            bounds = np.searchsorted(text, np.arange(grid.n_texts + 1)).astype(np.int32)
            rows = pa.StructArray.from_arrays([pa.array(x) for x in (word - grid.first[:-1][text], length, period)], names=["start", "length", "period"])
            kept = pa.LargeStringArray.from_buffers(grid.n_texts, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(grid.n_words), pa.ListArray.from_arrays(pa.array(bounds), rows), kept], names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start word, length, period, by start, then period), collapsed (the words joined by
    one space, of each run only the first period) per document. ``least``: an even number of words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(collapse(least), RUNS)


def with_periodic_tail(docs: DataFrame) -> DataFrame:
    """doc_id, text: one document in ten, by the CRC of its id, repeats the words from some place on to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    chosen = F.coalesce((h % 10 == 0) & F.col("text").rlike(WORD), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.where(chosen).select("doc_id", words.alias("w"), g.alias("g"), (g % F.size(words)).alias("a"))
    made = made.withColumn("p", 1 + F.floor((F.size("w") - F.col("a")) / (3 + F.col("g") % 8)))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), F.size("w") - F.col("a") - 1), lambda i: F.get("w", (F.col("a") + i % F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), tail), " ")
    return rows.where(~chosen).unionByName(made.select("doc_id", text.alias("text")))


def run_report(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """n_runs, the longest run, and digests of all runs and of the collapsed text, from ``find_runs``."""
    found = find_runs(docs, least)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
