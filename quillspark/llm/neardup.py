"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

1. Each text becomes the set of its distinct word shingles (64-bit hashes). Texts
   with equal sets form one class, carried by its smallest doc_id; only classes
   are sketched, so a million exact copies cost one row each.
2. The sketch has ``COORDINATES`` bins. In round i every shingle is thrown into a
   hashed bin with a value in [i, i + 1); a bin keeps its smallest value. Rounds
   0..t-1 choose the bin by hash, rounds t..2t-1 throw every shingle into bin
   i - t, so every coordinate fills and a set stops at the first round after
   which none is empty. Agreement of coordinates estimates Jaccard similarity
   with the concentration of t independent ones.
3. Bands of ``ROWS`` coordinates are hashed to buckets. At similarity 0.8 the
   chance that no band of 32 agrees is (1 - 0.8^4)^32 < 5e-8.
4. Classes that share a bucket are compared on their full sets, but never all
   pairs of a bucket. First each class meets the first class of each of its
   buckets. Where a bucket's members then still lie in several components, all
   of them are measured against one reference R, the first class of the
   component of the bucket's first member. For members x and y,
   |x and y| <= min(|x and R|, |y and R|) + |(x - R) and (y - R)|, so a link
   that is still missing needs either both overlaps with R large enough by
   themselves or enough shared shingles outside R. For the second, a prefix
   filter over the rarest shingles outside R finds the pairs for which it can
   hold; for the first, members of fitting sizes go through a prefix filter over
   the rarest of all their shingles. Only pairs found so are compared.
   Pairs inside one component cannot change the result.
   So no link between components is lost, and near copies of one text, which
   differ from it in their own ways, do not meet each other.
5. Components grow by alternating large-star and small-star steps over the
   confirmed links, in DataFrames, checkpointed each turn.

Nulls and odd rows: a null or empty text has no shingles and is linked with
nothing; rows with a null doc_id take no part and form their own (null)
component, kept; repeated rows of one doc_id have the same result if their texts
are equal, and each that of its own text if not. Extra columns of the input are
ignored by ``near_duplicates`` and carried by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spread import spread_join
from .storage import release, settle
from .textgrid import U64, Grid, blocks, grid_of, long_lists, mix, per_text

COORDINATES = 128
ROWS = 4
MEMBERS_PER_CHUNK = 64
EMPTY = U64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(grid: Grid, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after the other, and each text's bounds.

    A text of 1 to k-1 words has its whole sequence as its only shingle.
    """
    hashes = grid.word_hashes(lower=True)
    values, at = grid.windows(hashes, k)
    owner = grid.text[at]
    counts = grid.n_words
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            whole = hashes[grid.first[short]].copy()
            for j in range(1, n):
                whole = whole * U64(0xD6E8FEB86659FD93) + hashes[grid.first[short] + j]
            values = np.concatenate((values, mix(whole + U64(n))))
            owner = np.concatenate((owner, short))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[fresh], owner[fresh]
    return values, np.searchsorted(owner, np.arange(grid.n_texts + 1))


def sketch(values: np.ndarray, at: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """The fast similarity sketch of each set: an (n, t) array; empty sets stay EMPTY."""
    n = len(at) - 1
    bins = np.full((n, t), EMPTY, U64)
    flat = bins.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(at))
    for i in range(2 * t):
        if not len(values):
            break
        thrown = mix(values + U64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        where = (thrown % U64(t)).astype(np.int64) if i < t else i - t
        np.minimum.at(flat, owner * t + where, (thrown >> U64(8)) | U64(i << 56))
        open_sets = (bins == EMPTY).any(axis=1)
        more = open_sets[owner]
        values, owner = values[more], owner[more]
    return bins


def bands(bins: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket per band, the band's number hashed in."""
    n, t = bins.shape
    cut = bins.reshape(n, t // rows, rows)
    out = np.tile(mix(np.arange(t // rows, dtype=U64) + U64(77)), (n, 1))
    for j in range(rows):
        out = mix(out * U64(0xD6E8FEB86659FD93) + cut[:, :, j])
    return out


SIGNED = "doc_id long, text_key long, n long, d1 long, d2 long, buckets array<long>"


def sign_texts(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            values, at = shingle_sets(grid_of(block.column("text")), k)
            keys = bands(sketch(values, at))
            d1 = per_text(mix(values + U64(11)), at, np.add)
            d2 = per_text(mix(values + U64(29)), at, np.bitwise_xor)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("text_key"), pa.array(np.diff(at)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 long_lists(keys.reshape(-1), np.arange(len(keys) + 1) * keys.shape[1])],
                names=["doc_id", "text_key", "n", "d1", "d2", "buckets"],
            )

    return run


MEASURED = "a long, b long, c long, na long, n long, shared long, rest array<long>"


def measure_texts(k: int, percent: int, rest: bool):
    """Rows sorted by (a, chunk, the text of a first): sizes and overlap of a with each b out.

    Only one lead's set is held at a time. Without ``rest`` only linked pairs
    come out, else all, with the shingles of b outside a.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lead = None, np.zeros(0, U64)
        for block in blocks(batches):
            values, at = shingle_sets(grid_of(block.column("text")), k)
            out, outside = [], []
            for i, (a, chunk, b, c) in enumerate(zip(*(block.column(x).to_pylist() for x in ("a", "chunk", "b", "c")))):
                own = values[at[i] : at[i + 1]]
                if b is None:
                    key, lead = (a, chunk), own
                elif key == (a, chunk) and len(lead) and len(own):
                    hit = lead[np.minimum(np.searchsorted(lead, own), len(lead) - 1)] == own
                    both = int(hit.sum())
                    if rest or 100 * both >= percent * (len(lead) + len(own) - both):
                        out.append((a, b, c, len(lead), len(own), both))
                        outside.append(own[~hit] if rest else own[:0])
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in outside]))).astype(np.int64)
            columns = [pa.array([x[j] for x in out], pa.int64()) for j in range(6)]
            yield pa.RecordBatch.from_arrays([*columns, long_lists(np.concatenate([*outside, np.zeros(0, U64)]), bounds)], names=["a", "b", "c", "na", "n", "shared", "rest"])

    return run


def measure(pairs: DataFrame, texts: DataFrame, k: int, percent: int, rest: bool = False) -> DataFrame:
    """Distinct pairs (a, b, c) compared on the full sets of a and b; c is passed through.

    A lead with many partners is dealt out in chunks, its text repeated per chunk.
    """
    sizes = pairs.groupBy("a").agg(F.count("*").alias("__n")).withColumn("chunks", F.ceil(F.col("__n") / MEMBERS_PER_CHUNK))
    dealt = spread_join(pairs, sizes, ["a"], "__n", ["b"]).select("a", "b", "c", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    members = dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "chunk", "b", "c", "text")
    none = F.lit(None).cast("long")
    leads = dealt.select("a", "chunk").distinct().join(texts.withColumnRenamed("node", "a"), "a").select("a", "chunk", none.alias("b"), none.alias("c"), "text")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = leads.unionByName(members).repartition(n, "a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return rows.mapInArrow(measure_texts(k, percent, rest), MEASURED)


def linked(measured: DataFrame, percent: int) -> DataFrame:
    return measured.where(100 * F.col("shared") >= percent * (F.col("na") + F.col("n") - F.col("shared"))).select("a", "b")


def list_shingles(k: int):
    """The set of each row's text, the other columns passed through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            values, at = shingle_sets(grid_of(block.column("text")), k)
            names = [c for c in block.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*map(block.column, names), long_lists(values, at.astype(np.int64))], names=[*names, "rest"])

    return run


def rarest(members: DataFrame, size: Column, length: Column) -> DataFrame:
    """(a, h, and the members' other columns) of the first ``length`` of a member's ``size`` shingles in ``rest``.

    Per reference a the rare ones come first; those that only one member has come
    before all others and find nobody, so they are left out.
    """
    words = members.withColumn("__size", size.cast("long")).withColumn("__most", length.cast("long")).withColumn("h", F.explode("rest")).drop("rest")
    often = settle(words.groupBy("a", "h").agg(F.count("*").alias("__often")).where("__often > 1").withColumn("__n", F.col("__often")))
    each = Window.partitionBy("a", "b")
    place = F.col("__size") - F.count("*").over(each) + F.row_number().over(each.orderBy("__often", "h"))
    return settle(spread_join(words, often, ["a", "h"], "__n", ["b"]).withColumn("__place", place).where("__place <= __most").drop("__place", "__often", "__size", "__most"))


def possible_pairs(measured: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of members of different components that their overlaps with a common reference do not rule out.

    ``measured``: reference a, member b of component c, sizes, overlap, shingles outside a.
    """
    needed = lambda n: F.ceil(percent * n / (100 + percent))
    far = (F.col("cx") != F.col("a")) & (F.col("cx") != F.col("cy"))
    least = measured.groupBy("a").agg(F.min("n").alias("least"), F.count("*").alias("__n"))
    own = spread_join(measured, least, ["a"], "__n", ["b"]).withColumn("lack", needed(F.col("n") + F.col("least")) - F.col("shared"))
    index = rarest(own.select("a", "b", "c", "lack", "rest"), F.size("rest"), F.size("rest") - F.greatest("lack", F.lit(1)) + 1)
    x, y = (index.select("a", "h", F.col("b").alias(f"b{s}"), F.col("c").alias(f"c{s}")) for s in "xy")
    by_rest = x.where("cx <> a").join(y, ["a", "h"]).where(far)
    # members that could reach some other by what they share with the reference alone, of sizes that fit
    near = own.where("lack <= 0").select("a", "b", "c", "n", "shared")
    sizes = near.where("c <> a").groupBy("a").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    fits = (100 * F.col("n") >= percent * F.col("lo")) & (100 * F.col("hi") >= percent * F.col("n")) & (F.col("shared") >= needed(F.col("n") + F.col("lo")))
    near = settle(near.join(sizes, "a").where(fits).select("a", "b", "c", "n", "shared"))
    listed = near.join(texts.withColumnRenamed("node", "b"), "b").mapInArrow(list_shingles(k), "b long, a long, c long, n long, shared long, rest array<long>")
    index = rarest(listed, F.col("n"), F.col("n") - F.ceil(percent * F.col("n") / 100) + 1)
    x, y = (index.select("a", "h", *(F.col(v).alias(f"{v}{s}") for v in ("b", "c", "n", "shared"))) for s in "xy")
    by_core = x.where("cx <> a").join(y, ["a", "h"]).where(far & (F.least("sharedx", "sharedy") >= needed(F.col("nx") + F.col("ny"))))
    both = by_rest.select("bx", "by").union(by_core.select("bx", "by"))
    return both.select(F.least("bx", "by").alias("a"), F.greatest("bx", "by").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link.

    Alternates large-star and small-star; each turn is checkpointed and the
    turns needed grow with the logarithm of a component's size.
    """
    links = settle(links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("u <> v").distinct())
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(links)
    while before[0]:
        both = links.select("u", "v").union(links.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x")).select(F.col("x.v").alias("u"), F.col("x.m").alias("v"))
        links = settle(small.where("u <> v").distinct(), 2 * before[0])
        after = mark(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select(F.col("v"), F.col("v")).distinct())


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, keyed: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; with ``keyed`` also its text_key and the number of its group.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| for their
    sets of k-word shingles (A-Z lower-cased); component_id is the smallest
    doc_id reachable over links.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("string").alias("text"))
    signed = settle(own.mapInArrow(sign_texts(k), SIGNED))
    # numbered once, in what is written, by doc_id: originals mostly come before their copies, and the first
    # class of a bucket or component is what its other members are measured against
    classes = signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n").agg(F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("buckets").alias("buckets"))
    classes = settle(classes.orderBy("rep").select("d1", "d2", "n", "rep.doc_id", "rep.text_key", "buckets", F.monotonically_increasing_id().alias("node")))
    found = link_members(own, classes, classes.select(F.col("node").alias("rep"), F.explode("buckets").alias("bucket")), k, percent)
    out = placed_documents(signed, classes, found).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out if keyed else out.drop("text_key", "group")


def placed_documents(signed: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, group of every signed document, from its class and the components found."""
    named = classes.select("node", "doc_id").join(found, "node")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("smallest"))
    placed = found.join(smallest, "component").select("node", "component", "smallest")
    mine = classes.select("d1", "d2", "n", "doc_id", "node").join(placed, "node", "left").select("d1", "d2", "n", F.coalesce("smallest", "doc_id").alias("component_id"), F.coalesce("component", "node").alias("group"))
    rows = signed.select("doc_id", "text_key", "n", "d1", "d2")
    linked = rows.where("n > 0 AND doc_id IS NOT NULL").join(mine, ["d1", "d2", "n"]).select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id", "group")
    alone = rows.where("NOT (n > 0 AND doc_id IS NOT NULL)").select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when each group of near-duplicates keeps one.

    A group keeps one row of its smallest doc_id, of that doc_id's texts in the
    group the one with the smallest key, of rows equal in both any one. Rows
    with a null doc_id or without a word are near nothing and all stay.
    """
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    judged = F.col("doc_id").isNotNull() & F.coalesce(F.col("row.text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    chosen = near_duplicates(docs, k, percent, keyed=True).where("kept AND group IS NOT NULL").groupBy("group").agg(F.first("doc_id").alias("doc_id"), F.min("text_key").alias("text_key"))
    # repeated rows meet in a partial aggregate before the shuffle
    once = whole.where(judged).groupBy("doc_id", "text_key").agg(F.first("row").alias("row"))
    stay = once.join(chosen, ["doc_id", "text_key"], "left_semi")
    return stay.select("row.*").unionByName(whole.where(~judged).select("row.*"))


def link_members(docs: DataFrame, classes: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component) for classes that have a partner, if partners share some bucket of ``rows`` (rep: a class's node, bucket)."""
    spark = docs.sparkSession
    shared = rows.groupBy("bucket").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead <> last")
    members = settle(rows.join(shared.select("bucket", "lead"), "bucket"))
    wanted = members.select(F.col("rep").alias("node")).distinct().join(classes.select("node", "doc_id", "text_key"), "node")
    once = docs.groupBy("doc_id", "text_key").agg(F.first("text").alias("text"))
    texts = settle(once.join(wanted, ["doc_id", "text_key"]).select("node", "text"))
    release(spark)
    none = F.lit(None).cast("long").alias("c")
    pairs = settle(members.where("lead <> rep").select(F.col("lead").alias("a"), F.col("rep").alias("b"), none).distinct())
    links = settle(linked(measure(pairs, texts, k, percent), percent))
    found = settle(components(links))
    release(spark)
    placed = members.join(found, members["rep"] == found["node"], "left").select("bucket", "rep", F.coalesce("component", "rep").alias("c"))
    split = placed.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min(F.struct("rep", "c")).alias("first")).where("low <> high")
    pairs = placed.join(split.select("bucket", F.col("first.c").alias("a")), "bucket").where("a <> rep").select("a", F.col("rep").alias("b"), "c").distinct()
    measured = settle(measure(settle(pairs), texts, k, percent, rest=True))
    release(spark)
    more = settle(possible_pairs(measured, texts, k, percent).withColumn("c", none))
    fresh = settle(linked(measured, percent).union(linked(measure(more, texts, k, percent), percent)))
    release(spark)
    return settle(components(links.union(fresh)))
