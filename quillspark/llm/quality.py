"""Quality rules whose cutoffs carry a risk guarantee.

Every rule scores a document (larger is worse) against a ladder of cutoffs from
lax to strict. A setting holds one cutoff (or none) per rule and rejects what any
of them rejects. Per stratum, settings are put into a sequence, each stricter
than the one before: the next one tightens the rule that adds the most bad
labelled documents for the unlabelled ones it adds. The good labelled documents
have no part in that order, so on them the settings can be tested one after the
other: the null hypothesis "this setting rejects more than ``risk`` of the
stratum's good documents" is rejected if the exact binomial tail (the
Clopper-Pearson bound) allows it at level delta / (strata tested), and testing
stops at the first setting that fails (fixed-sequence testing needs no further
correction; Bonferroni covers the strata). Strata whose good labels are too few
for any setting to pass are not tested and do not count. So with probability
1 - delta the verdict of all rules together falsely rejects more than ``risk`` of
the good documents in no stratum.

Of the settings that passed, the one counts that rejects most bad minus
``GOOD_COST`` times good holdout documents, the laxer one of equals; if none
gains, the stratum's rules abstain.

Nulls and odd rows: a null text has no words; a null stratum is a stratum of its
own; repeated labels of one document count once and as good if any says so, and
so do repeated rows of a labelled doc_id, at the worst score of each rule;
labels that are null, or of documents that are not there, do not count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import settle
from .textgrid import Grid, blocks, grid_of

RISK = 0.01
DELTA = 0.05
GOOD_COST = 10
LEAST_LIFT = 2.0
BROADCAST_STRATA = 10_000

#: Cutoffs of each rule, lax to strict; a document is rejected if its score is above.
LADDERS = {
    "symbols": (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05),
    "dup_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3),
    "repeats": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
    "capitals": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "marks": (3.0, 2.0, 1.5, 1.2, 1.0, 0.8, 0.6, 0.5, 0.4),
    "long_words": (40.0, 30.0, 25.0, 20.0, 17.5, 15.0, 12.5, 11.0, 10.0),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORED = "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{r} int" for r in LADDERS)


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


SYMBOLS, UPPER, LOWER, MARKS = _flags("#*$%&|<>"), _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("abcdefghijklmnopqrstuvwxyz"), _flags("!?|#*$%&<>")


def line_counts(grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    r"""Per text: lines (split at \n) with a word, and those equal to an earlier line."""
    cuts = np.flatnonzero(grid.data == 10)
    start = np.sort(np.concatenate((grid.text_at[:-1], cuts + 1)))
    owner = np.searchsorted(grid.text_at[:-1], start, side="right") - 1  # an empty text's line is empty and drops out below
    end = np.sort(np.concatenate((grid.text_at[1:], cuts)))
    words = np.searchsorted(grid.start, end) - np.searchsorted(grid.start, start)
    used = (words > 0) & (end > start)
    start, end, owner = start[used], end[used], owner[used]
    hashes = grid.span_hashes(start, end, stream=5)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    n = grid.n_texts
    return np.bincount(owner, minlength=n), np.bincount(owner[again], minlength=n)


def repeat_words(grid: Grid, k: int = 3) -> np.ndarray:
    """Per text: words inside k-word windows that the text has twice or more."""
    values, at = grid.windows(grid.word_hashes(), k)
    owner = grid.text[at]
    order = np.lexsort((values, owner))
    same = (values[order][1:] == values[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(values), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(grid.start), bool)
    for j in range(k):
        covered[at[twice] + j] = True
    return np.bincount(grid.text[covered], minlength=grid.n_texts)


def score_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of each text and, per rule, how many cutoffs of the ladder it is above; a column ``row`` is passed through."""
    for block in blocks(batches):
        grid = grid_of(block.column("text"))
        data = grid.data
        in_word = ~((data == 32) | ((data >= 9) & (data <= 13)))
        n = grid.n_words
        lines, dup = line_counts(grid)
        counts = dict(zip(COUNTS, (n, grid.count(in_word & (data & 0xC0 != 0x80)), grid.count(SYMBOLS[data]), dup, repeat_words(grid))))
        upper, lower = grid.count(UPPER[data]), grid.count(LOWER[data])
        some = np.maximum(n, 1)
        scores = {
            "symbols": counts["n_symbols"] / some,
            "dup_lines": dup / np.maximum(lines, 1),
            "repeats": counts["n_repeat_words"] / some,
            "capitals": upper / np.maximum(upper + lower, 1),
            "marks": grid.count(MARKS[data]) / some,
            "long_words": counts["word_chars"] / some,
        }
        levels = [(scores[r][:, None] > np.array(ladder)).sum(axis=1).astype(np.int32) for r, ladder in LADDERS.items()]
        carried = ["row"] if "row" in block.schema.names else []
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), block.column("stratum"), *(pa.array(np.asarray(v, np.int64)) for v in counts.values()), *map(pa.array, levels), *map(block.column, carried)],
            names=["doc_id", "stratum", *COUNTS, *LADDERS, *carried],
        )


def binomial_below(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    term = n * math.log1p(-p)
    odds, total = math.log(p) - math.log1p(-p), [term]
    for i in range(k):
        term += math.log((n - i) / (i + 1)) + odds
        total.append(term)
    top = max(total)
    return math.exp(top) * math.fsum(math.exp(x - top) for x in total)


def setting_path(levels: np.ndarray, bad: np.ndarray, other: np.ndarray) -> list[np.ndarray]:
    """Settings from lax to strict. Row i of ``levels``: how many cutoffs of each rule the documents are above that bad[i] and other[i] count.

    A setting holds each rule's cutoff number from 1; one past the ladder's end is none.
    """
    cuts = np.array([len(ladder) + 1 for ladder in LADDERS.values()])
    n_bad, n_other, out = int(bad.sum()), int(other.sum()), []
    while True:
        best, step = (0.0, 0), None
        for r in range(len(cuts)):
            # documents not rejected yet, from the rule's strictest used cutoff downwards
            more_bad = np.bincount(levels[:, r], bad, cuts[r])[::-1].cumsum()[::-1]
            more_other = np.bincount(levels[:, r], other, cuts[r])[::-1].cumsum()[::-1]
            for cut in range(int(cuts[r]) - 1, 0, -1):
                lift = (more_bad[cut] / max(n_bad, 1)) / ((more_other[cut] + 1) / (n_other + 1))
                if more_bad[cut] and lift >= LEAST_LIFT and (lift, more_bad[cut]) > best:
                    best, step = (lift, more_bad[cut]), (r, cut)
        if step is None:
            return out
        cuts = cuts.copy()
        cuts[step[0]] = step[1]
        out.append(cuts)
        stay = levels[:, step[0]] < step[1]
        levels, bad, other = levels[stay], bad[stay], other[stay]


def choose_setting(levels: np.ndarray, good: np.ndarray, bad: np.ndarray, other: np.ndarray, risk: float, level: float) -> np.ndarray | None:
    """The setting that counts, or None: see the module."""
    n, best, chosen = int(good.sum()), 0, None
    for cuts in setting_path(levels, bad, other):
        out = (levels >= cuts).any(axis=1)
        false, true = int(good[out].sum()), int(bad[out].sum())
        if not n or binomial_below(false, n, risk) > level:
            break
        if true - GOOD_COST * false > best:
            best, chosen = true - GOOD_COST * false, cuts
    return chosen


def cutoffs(scored: DataFrame, labels: DataFrame, risk: float, delta: float) -> DataFrame:
    """One row per stratum of the holdout: the chosen cutoff's number of each rule (null: abstains).

    Rows are counted by their levels before anything else; a stratum has at most
    as many kinds of rows as there are settings, whatever the documents.
    """
    rules = list(LADDERS)
    held = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q")).where("doc_id IS NOT NULL AND q IS NOT NULL").groupBy("doc_id").agg((F.max("q") > 0).alias("good"))
    marked = scored.select("doc_id", "stratum", *rules).join(held, "doc_id", "left")
    one = marked.where("good IS NOT NULL").groupBy("doc_id", "stratum").agg(F.first("good").alias("good"), *(F.max(r).alias(r) for r in rules))
    rows = one.unionByName(marked.where("good IS NULL"))
    counts = settle(rows.groupBy("stratum", *rules).agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"), F.count_if(F.col("good").isNull()).alias("n_other")))
    # strata by their good labels: as many are tested as could pass without any false rejection
    strata = counts.groupBy("stratum").agg(F.sum("n_good").alias("n")).where("n > 0").withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "stratum")))
    tested = strata.where(F.col("n") * math.log1p(-risk) <= F.log(F.lit(delta)) - F.log("place"))
    most = tested.agg(F.max("place")).first()[0] or 0

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        found = choose_setting(*(rows[c].to_numpy() for c in (rules, "n_good", "n_bad", "n_other")), risk, delta / most)
        cuts = [None if found is None or found[i] > len(LADDERS[r]) else int(found[i]) for i, r in enumerate(rules)]
        return pd.DataFrame([[rows["stratum"].iloc[0], *cuts]], columns=["stratum", *(f"cut_{r}" for r in rules)]).astype({f"cut_{r}": "Int32" for r in rules})

    return counts.join(strata.where(F.col("place") <= most).select("stratum"), "stratum").groupBy("stratum").applyInPandas(choose, "stratum string, " + ", ".join(f"cut_{r} int" for r in rules))


def _verdict(scored: DataFrame, chosen: DataFrame) -> DataFrame:
    """``base_failed``, ``rejected_by`` and ``kept`` added to scored rows."""
    if chosen.count() <= BROADCAST_STRATA:
        chosen = F.broadcast(chosen)
    rejected = F.array_compact(F.array(*(F.when(F.col(r) >= F.col(f"cut_{r}"), F.lit(r)) for r in LADDERS)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = scored.join(chosen, "stratum", "left").withColumn("base_failed", failed).withColumn("rejected_by", rejected)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def _inputs(docs: DataFrame, stratum: str) -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("null")).alias("stratum"), F.col("text").cast("string").alias("text")]


def judge_quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and rejected_by (rules that rejected it) per document."""
    scored = settle(docs.select(*_inputs(docs, stratum)).mapInArrow(score_texts, SCORED))
    chosen = settle(cutoffs(scored, labels, risk, delta))
    return _verdict(scored, chosen).select("doc_id", *COUNTS, "base_failed", "rejected_by", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The rows are scored a second time, with themselves beside the scores: no text
    is shuffled or joined, and every row has its own verdict, repeated and null
    doc_ids included.
    """
    own = docs.select(*_inputs(docs, stratum))
    chosen = settle(cutoffs(settle(own.mapInArrow(score_texts, SCORED)), labels, risk, delta))
    whole = docs.select(*_inputs(docs, stratum), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kind = whole.schema["row"].dataType.simpleString()
    return _verdict(whole.mapInArrow(score_texts, f"{SCORED}, row {kind}"), chosen).where("kept").select("row.*")
