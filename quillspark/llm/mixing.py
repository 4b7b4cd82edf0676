"""Mixing sources to target weights by subset-sum budget fitting.

1. Documents are counted by exact length per source; these counts, never the
   documents, go to the fitting.
2. The budget is shared by weight; a source takes at most ``MOST_PASSES`` times
   its size, and what it cannot take is shared among the others by weight. The
   closed form of that resharing is a search over one row per source.
3. A source passes its whole documents floor(target / size) times. What remains
   of its target is fitted to the length counts: a proportional share of every
   length, single documents in a seeded order until less than ``EXACT_WORDS`` (or
   one longest document) remains, then bounded-knapsack dynamic programming
   over the lengths left for the largest sum that fits.
4. Documents are chosen by length count in the order of a seeded hash. Large
   (source, length) groups are cut into hash buckets of about ``BUCKET_ROWS``
   rows; whole buckets are taken until the count is reached and only the last
   one is ranked, so no task sorts a group; nor does one task meet such a group
   with its counts.

The same rows and seed give the same mix, however rows are partitioned.

The dynamic program sees the last ``EXACT_WORDS`` words (or one longest document)
of a source's budget, so its memory is bounded whatever the corpus; everything
before is a proportional share of every length. What a source takes stays below
its target by less than its longest document, and by 0 wherever some sum of the
lengths left meets the remainder.

Nulls and odd rows: a null source is a source of its own, last in order; null and
empty texts have size 0 and take 0 words; repeated rows count as often as they
occur, each with copies of its own; extra columns are ignored by
``mix_documents`` and carried by ``repeat_taken``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .neardup import text_key
from .spread import spread_join
from .storage import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2
SEED = 17
EXACT_WORDS = 1 << 16
BUCKET_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def share_budget(sources: DataFrame, weights: tuple[float, ...], share: float, passes: int) -> DataFrame:
    """source_key, source_size, target for (source_key, source_size) rows.

    Sources are few (one row each, whatever the documents), so plain windows
    over them do. Sorted by passes * size / weight, capped sources come first:
    the common rate is the first at which the uncapped ones stay below it.
    """
    order = Window.orderBy((F.col("source_key") == "null").cast("int"), "source_key")
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("w", w).withColumn("cap", passes * F.col("source_size").cast("double")).withColumn("full_at", F.col("cap") / F.col("w"))
    everything, before = Window.partitionBy(F.lit(1)), Window.partitionBy(F.lit(1)).orderBy("full_at", "source_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("budget", share * F.sum("source_size").over(everything))
    rows = rows.withColumn("rate", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    rate = F.coalesce(F.min(F.when(F.col("full_at") > F.col("rate"), F.struct("full_at", "rate"))).over(everything)["rate"], F.max("full_at").over(everything))
    return rows.select("source_key", "source_size", F.least("cap", F.col("w") * rate).alias("target"))


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int, exact_words: int = EXACT_WORDS) -> np.ndarray:
    """How many documents of each length to take so that their words come closest to ``budget`` from below."""
    total = int((sizes * counts).sum())
    take = np.zeros(len(sizes), np.int64)
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return np.where(sizes > 0, counts, 0)
    take = np.array([int(c) * budget // total for c in counts], np.int64)
    take[sizes == 0] = 0
    left = budget - int((sizes * take).sum())
    for i in np.random.default_rng(seed).permutation(len(sizes)):
        if left <= exact_words:
            break
        if 0 < sizes[i] <= left and take[i] < counts[i]:
            take[i] += 1
            left -= int(sizes[i])
    # bounded knapsack: via[s] is the item with which sum s was first reached
    items = []
    for i in np.flatnonzero((sizes > 0) & (sizes <= left) & (take < counts)):
        most, step = min(int(counts[i] - take[i]), left // int(sizes[i])), 1
        while most > 0:
            n = min(step, most)
            items.append((int(i), n, n * int(sizes[i])))
            most, step = most - n, step * 2
    via = np.full(left + 1, -1, np.int32)
    reached = np.zeros(left + 1, bool)
    reached[0] = True
    for j, (_, _, words) in enumerate(items):
        if reached[left]:
            break
        fresh = reached[: left + 1 - words] & ~reached[words:]
        spots = np.flatnonzero(fresh) + words
        via[spots] = j
        reached[spots] = True
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n, words = items[via[at]]
        take[i] += n
        at -= words
    return take


def mix_documents(docs: DataFrame, source: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = MOST_PASSES, seed: int = SEED, keyed: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies per document; taken is copies * size. ``keyed``: also source_key, text_key."""
    text = F.col("text").cast("string")
    rows = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col(source)).alias("source_key"), text_key(text).alias("text_key"), word_count(text).alias("size")))
    lengths = settle(rows.groupBy("source_key", "size").agg(F.count("*").alias("n")))
    sources = lengths.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = settle(share_budget(sources, weights, share, passes))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size")
        key, whole, target = part["source_key"].iloc[0], int(part["source_size"].iloc[0]), float(part["target"].iloc[0])
        full = min(int(target // whole), passes) if whole else 0
        own_seed = (seed << 32) ^ int.from_bytes(key.encode()[-8:], "big")
        part["taken_n"] = fit_counts(part["size"].to_numpy(), part["n"].to_numpy(), int(target - full * whole) if full < passes else 0, own_seed)
        part["full"] = full
        return part[["source_key", "size", "n", "source_size", "target", "full", "taken_n"]]

    plan = settle(lengths.join(targets, "source_key").groupBy("source_key").applyInPandas(fit, "source_key string, size long, n long, source_size long, target double, full long, taken_n long"))

    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40))
    # a length that very many documents of a source have is met by many tasks
    placed = spread_join(rows, plan.withColumn("rows", F.col("n")), ["source_key", "size"], "rows", ["doc_id", "text_key"]).withColumn("draw", draw)
    placed = placed.withColumn("bucket", F.floor(F.col("draw") * F.ceil(F.col("n") / BUCKET_ROWS) / float(1 << 40)).cast("long"))
    partly = (F.col("taken_n") > 0) & (F.col("taken_n") < F.col("n"))
    sure = placed.where(~partly).withColumn("extra", (F.col("taken_n") > 0).cast("long"))
    some = placed.where(partly)
    buckets = some.groupBy("source_key", "size", "bucket").agg(F.count("*").alias("m"), F.first("taken_n").alias("c"))
    before = Window.partitionBy("source_key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = buckets.select("source_key", "size", "bucket", (F.col("c") - F.coalesce(F.sum("m").over(before), F.lit(0))).alias("quota"))
    ranked = some.join(quota, ["source_key", "size", "bucket"]).withColumn("rank", F.row_number().over(Window.partitionBy("source_key", "size", "bucket").orderBy("draw", "doc_id", "text_key")))
    chosen = ranked.withColumn("extra", (F.col("rank") <= F.col("quota")).cast("long"))
    names = ["doc_id", "source_key", "text_key", "size", "source_size", "target", "full", "extra"]
    both = sure.select(*names).unionByName(chosen.select(*names))
    copies = F.col("full") + F.col("extra")
    return both.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), *["source_key", "text_key"] * keyed)


def repeat_taken(docs: DataFrame, source: str = "source", **settings) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it.

    Copies go back to rows by doc_id, source and text; rows equal in all three
    share theirs evenly, in one window for each such group.
    """
    key = ["doc_id", "source_key", "text_key"]
    taken = mix_documents(docs, source, keyed=True, **settings).groupBy(*key).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col(source)).alias("source_key"), text_key(F.col("text")).alias("text_key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"t.{c}")) for c in key]
    found = whole.alias("w").join(taken.where("copies > 0").alias("t"), same[0] & same[1] & same[2]).select("w.*", "copies", "rows")
    once = found.where("rows = 1").select("row", "copies")
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(F.to_json("row"))))
    shared = found.where("rows > 1").withColumn("place", place).select("row", (F.floor(F.col("copies") / F.col("rows")) + (F.col("place") <= F.col("copies") % F.col("rows")).cast("long")).alias("copies"))
    each = once.unionByName(shared).where("copies > 0")
    return each.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
