"""Similarity join of documents on word shingles by token-combination prefixes.

1. Each text becomes the set of its distinct word shingles (tokens, 64-bit
   hashes). Texts with equal sets form one class; only classes are joined.
2. Sets x and y with 100 * |x and y| >= percent * |x or y| differ by at most
   slack = |x| - ceil(percent * |x| / 100) tokens of x (and likewise of y). A prefix
   holds the first slack + least tokens in the order of their hashes. Of two linked
   sets that whose prefix ends first finds all but slack of it in the other's, so
   the prefixes have ``least`` tokens or more in common.
3. Tokens are counted over all prefixes. Those that others have too are put in order
   again, rare ones first; of s such tokens at most s - least can be missing from a
   partner's. A set with s < least has no partner.
4. Rare tokens are indexed singly; tokens that ``FREQUENT`` sets or more have make
   classes, by hash, of which combinations of k tokens are indexed. A set's list is
   extended until its rare tokens, and those of each frequent class beyond the first
   k - 1, number s - least + 1. If x and y shared neither a rare token nor k tokens
   of a frequent class of their lists, more than s - least tokens of one were
   missing from the other; so linked sets share a signature.
5. ``least`` and the number of frequent classes follow the size of the set, in powers
   of two, so that a class has a few tokens of a list and combinations grow with the
   set, not with its square. A set is indexed at the level of its own size and at
   that of the smallest size it can be linked with; a signature holds its level,
   which also keeps apart what differs too much in size.
6. Classes that share a signature are compared on their full sets, never all pairs
   of them, and components grown, as in ``neardup``.

Hot tokens are split over tasks where their rows meet their counts.

Nulls and odd rows: a null or empty text has no shingles and is linked with
nothing; rows with a null doc_id take no part (their component is null); repeated
rows of one doc_id have the same result if their texts are equal, and each that of
its own text if not; texts of fewer words than a shingle have their whole sequence
as the only one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .neardup import link_members, placed_documents, shingle_sets, text_key
from .spread import spread_join
from .storage import release, settle
from .textgrid import U64, blocks, grid_of, long_lists, mix, per_text

FREQUENT = 32
TOGETHER = 2


def level_of(n: np.ndarray) -> np.ndarray:
    """The power of two at or below each size."""
    return np.frexp(np.maximum(n, 1).astype(np.float64))[1].astype(np.int64) - 1


def slack_of(n: np.ndarray, percent: int) -> np.ndarray:
    """How many tokens of a set of n a linked one can lack."""
    return n - smallest_partner(n, percent)


def smallest_partner(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-percent * n // 100)


def least_common(level: np.ndarray, percent: int) -> np.ndarray:
    """How many tokens the prefixes of linked sets of a level have in common at least: a quarter of the slack, or one."""
    return np.maximum(1, (1 << level) * (100 - percent) // 400)


def class_count(level: np.ndarray, percent: int, k: int) -> np.ndarray:
    """How many classes the frequent tokens of a level have: as many as lists can be extended for; 0: single tokens only."""
    return (least_common(level, percent) - 1) // max(1, k - 1)


def prefix_length(n: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(n, slack_of(n, percent) + least_common(level, percent))


PROFILE = "doc_id long, text_key long, n long, d1 long, d2 long, prefix array<long>"


def prefix_texts(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            values, at = shingle_sets(grid_of(block.column("text")), shingle)
            n = np.diff(at)
            size = prefix_length(n, level_of(n), percent)
            inside = np.arange(len(values)) - np.repeat(at[:-1], n) < np.repeat(size, n)
            d1, d2 = per_text(mix(values + U64(11)), at, np.add), per_text(mix(values + U64(29)), at, np.bitwise_xor)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("text_key"), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), long_lists(values[inside], np.concatenate(([0], np.cumsum(size))))],
                names=["doc_id", "text_key", "n", "d1", "d2", "prefix"],
            )

    return run


def combinations(group: np.ndarray, k: int) -> list[np.ndarray]:
    """The k columns of all combinations of k rows of one group; ``group`` is in order."""
    if not len(group):
        return [np.zeros(0, np.int64)] * k
    end = np.searchsorted(group, group, side="right")
    columns = [np.arange(len(group))]
    for _ in range(k - 1):
        last = columns[-1]
        more = end[last] - last - 1
        owner = np.repeat(np.arange(len(last)), more)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(more) - more, more) + 1
        columns = [c[owner] for c in columns] + [last[owner] + step]
    return columns


def signatures(n: np.ndarray, level: np.ndarray, owner: np.ndarray, rank: np.ndarray, token: np.ndarray, often: np.ndarray, percent: int, k: int, frequent: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Owner and signature of sets of size n[owner], indexed at a level each.

    ``rank``: a token's place in its set; tokens of a prefix that no other prefix
    has may be left out.
    """
    inside = rank < prefix_length(n, level, percent)[owner]
    owner, token, often = owner[inside], token[inside], often[inside]
    held, least = np.bincount(owner, minlength=len(n)), least_common(level, percent)
    order = np.lexsort((token, often, owner))
    owner, token, often = owner[order], token[order], often[order]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    classes = class_count(level, percent, k)[owner]
    common = (often >= frequent) & (classes > 0)
    part = (mix(token + U64(51)) % np.maximum(classes, 1).astype(U64)).astype(np.int64)
    spot = np.flatnonzero(common)
    order = spot[np.lexsort((spot, part[spot], owner[spot]))]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (owner[order][1:] != owner[order][:-1]) | (part[order][1:] != part[order][:-1])
    group = np.cumsum(fresh) - 1
    within = np.arange(len(order)) - np.flatnonzero(fresh)[group] if len(order) else group
    # the first k - 1 tokens of a class tell nothing: each lengthens the list by one
    idle = np.sort(order[within < k - 1])
    before = np.arange(len(idle)) - np.searchsorted(owner[idle], owner[idle])
    need = held - least + 1
    reached = place[idle] < need[owner[idle]] + before
    size = np.where(need > 0, need + np.bincount(owner[idle[reached]], minlength=len(n)), 0)
    kept = place < size[owner]
    salt = mix(level.astype(U64) + U64(90))
    one = np.flatnonzero(kept & ~common)
    own, values = [owner[one]], [mix(token[one] ^ salt[owner[one]])]
    order, group = order[kept[order]], group[kept[order]]
    columns = combinations(group, k)
    own.append(owner[order[columns[0]]])
    value = salt[own[1]]
    for c in columns:
        value = mix(value * U64(0xD6E8FEB86659FD93) + token[order[c]])
    values.append(value)
    return np.concatenate(own), np.concatenate(values)


def sign_sets(percent: int, k: int, frequent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n = np.asarray(batch.column("node")), np.asarray(batch.column("n"))
            found = batch.column("found")
            owner, items = np.repeat(np.arange(len(node)), np.asarray(found.value_lengths())), found.flatten()
            rank, token, often = (np.asarray(items.field(i)) for i in range(3))
            top, low = level_of(n), level_of(smallest_partner(n, percent))
            for level, which in ((top, np.ones(len(n), bool)), (low, low != top)):
                rows = which[owner]
                own, value = signatures(n, level, owner[rows], rank[rows].astype(np.int64), token[rows].view(U64), often[rows], percent, k, frequent)
                yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(value.view(np.int64))], names=["rep", "bucket"])

    return run


def index_sets(sets: DataFrame, percent: int, k: int, frequent: int) -> DataFrame:
    """(rep, bucket): the signatures of sets (node, n, prefix)."""
    tokens = sets.select("node", F.posexplode("prefix").alias("rank", "h"))
    shared = settle(tokens.groupBy("h").agg(F.count("*").alias("rows")).where("rows > 1").withColumn("often", F.col("rows")))
    release(sets.sparkSession)
    held = spread_join(tokens, shared, ["h"], "rows", ["node"])
    found = held.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("rank", "h", "often"))).alias("found"))
    return found.join(sets.select("node", "n"), "node").mapInArrow(sign_sets(percent, k, frequent), "rep long, bucket long")


def similar_documents(docs: DataFrame, shingle: int = 5, percent: int = 80, k: int = TOGETHER, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles, component_id per document: the smallest doc_id reachable over links between similar sets."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("string").alias("text"))
    signed = settle(own.mapInArrow(prefix_texts(shingle, percent), PROFILE).withColumn("row", F.monotonically_increasing_id()))
    classes = signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n").agg(F.min(F.struct("doc_id", "text_key", "row")).alias("rep"))
    classes = settle(classes.orderBy("rep").select("d1", "d2", "n", "rep.doc_id", "rep.text_key", "rep.row", F.monotonically_increasing_id().alias("node")))
    sets = settle(signed.select("row", "n", "prefix").join(classes.select("row", "node"), "row").select("node", "n", "prefix"))
    release(spark)
    rows = settle(index_sets(sets, percent, k, frequent))
    del sets
    release(spark)
    found = link_members(own, classes, rows, shingle, percent)
    return placed_documents(signed, classes, found).drop("text_key", "group")
