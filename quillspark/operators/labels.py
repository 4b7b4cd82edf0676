"""Label vocabularies, splits that do not depend on partitions, oversampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IGNORED = -100


def label_list(tags: DataFrame, column: str = "label") -> DataFrame:
    """id, label: O first, then the others in code-point order."""
    others = tags.select(F.col(column).alias("label")).where("label <> 'O' AND label IS NOT NULL").distinct()
    all_ = tags.sparkSession.createDataFrame([("O",)], "label string").union(others)
    order = Window.orderBy((F.col("label") != "O").cast("int"), "label")  # one row per distinct label
    return all_.select((F.row_number().over(order) - 1).cast("long").alias("id"), "label")


def label_maps(listed: DataFrame) -> DataFrame:
    """One row with label2id and id2label; labels are few."""
    pairs = F.array_sort(F.collect_list(F.struct("id", "label")))
    swapped = F.transform(pairs, lambda x: F.struct(x["label"], x["id"]))
    return listed.agg(F.map_from_entries(swapped).alias("label2id"), F.map_from_entries(pairs).alias("id2label"))


def draw(seed: int, *key: Column | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key)))


def ranked(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """``rank`` (from 1) in the seeded order and ``total`` added.

    Ranks come in two steps (within blocks of the hash, then over the blocks'
    counts), so no task orders the whole table.
    """
    marked = rows.withColumn("__draw", draw(seed, key)).withColumn("__block", F.conv(F.substring("__draw", 1, 2), 16, 10).cast("int"))
    counts = marked.groupBy("__block").agg(F.count("*").alias("__n"))  # at most 256 rows
    base = counts.select("__block", F.coalesce(F.sum("__n").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"), F.sum("__n").over(Window.partitionBy(F.lit(1))).alias("total"))
    return marked.join(F.broadcast(base), "__block").withColumn("rank", F.col("__base") + F.row_number().over(Window.partitionBy("__block").orderBy("__draw", key))).drop("__draw", "__block", "__base")


def front_split(rows: DataFrame, key: str, train: float, valid: float, seed: int = 42) -> DataFrame:
    """``split``: int(n * valid / (train + valid)) rows from the front of the seeded order are valid, the others train."""
    cut = F.floor(F.col("total") * F.lit(valid) / F.lit(train + valid))
    return ranked(rows, key, seed).withColumn("split", F.when(F.col("rank") <= cut, "valid").otherwise("train")).drop("rank", "total")


def exact_split(rows: DataFrame, key: str, parts: list[tuple[str, float]], seed: int = 42) -> DataFrame:
    """``split`` added: exactly floor(n * share) rows of the seeded order for each part in turn, the last part the rest."""
    marked = ranked(rows, key, seed).withColumnsRenamed({"rank": "__rank", "total": "__total"})
    split, upto = None, F.lit(0)
    for name, share in parts[:-1]:
        upto = upto + F.floor(F.col("__total") * F.lit(share))
        split = (F.when if split is None else split.when)(F.col("__rank") <= upto, F.lit(name))
    last = F.lit(parts[-1][0])
    return marked.withColumn("split", last if split is None else split.otherwise(last)).drop("__total", "__rank")


def oversample(base: DataFrame, real: DataFrame, weight: int) -> DataFrame:
    """The base rows and every real row ``weight`` times (0 or less: none)."""
    repeated = real.withColumn("__i", F.explode(F.sequence(F.lit(1), F.lit(weight)) if weight > 0 else F.array().cast("array<int>"))).drop("__i")
    return base.unionByName(repeated)


def shuffled(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return rows.orderBy(draw(seed, key), key)


def align_to_subwords(tags: Column, sizes: Column, label_ids: Column) -> Column:
    """Label ids per sub-word: the word's on its first, -100 on the others; unknown tags count as O."""
    o = F.coalesce(F.element_at(label_ids, F.lit("O")), F.lit(0))
    per_word = F.zip_with(tags, sizes, lambda t, n: F.when(n > 0, F.concat(F.array(F.coalesce(F.try_element_at(label_ids, t), o)), F.array_repeat(F.lit(IGNORED), n - 1))).otherwise(F.array().cast("array<int>")))
    return F.flatten(per_word)


def bad_label_ids(windows: DataFrame, n_labels: int, column: str = "labels") -> DataFrame:
    """How many labels lie outside [0, n) and are not -100."""
    bad = F.size(F.filter(column, lambda x: ((x < 0) | (x >= n_labels)) & (x != IGNORED)))
    return windows.agg(F.coalesce(F.sum(bad), F.lit(0)).alias("n_bad"))


def checked_label_ids(windows: DataFrame, n_labels: int, column: str = "labels") -> DataFrame:
    """The windows; a label id outside [0, n) other than -100 is an error when its row is computed."""
    bad = F.exists(column, lambda x: ((x < 0) | (x >= n_labels)) & (x != IGNORED))
    return windows.withColumn(column, F.when(bad, F.raise_error(F.lit(f"a label id lies outside 0..{n_labels - 1}"))).otherwise(F.col(column)))
