"""The registry of models: local and published ones merged, looked up, kept fresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import display_name

FIELDS = "doc_type string, name string, repo_id string, source string, hub_verified boolean, tags array<string>"
TTL_SECONDS = 3600


def merge(local: DataFrame, hub: DataFrame) -> DataFrame:
    """One row per type: published rows give repo_id, tags and source where there are some, local ones the rest."""
    a, b = local.select("doc_type", *(F.col(c).alias(f"l_{c}") for c in ("name", "repo_id", "source", "tags"))), hub.select("doc_type", *(F.col(c).alias(f"h_{c}") for c in ("name", "repo_id", "tags")), F.lit(True).alias("on_hub"))
    rows = a.join(b, "doc_type", "full_outer")
    on_hub = F.coalesce("on_hub", F.lit(False))
    return rows.select(
        "doc_type", F.coalesce("l_name", "h_name", display_name(F.col("doc_type"))).alias("name"), F.coalesce("h_repo_id", "l_repo_id").alias("repo_id"),
        F.when(on_hub, "hub").otherwise(F.col("l_source")).alias("source"), on_hub.alias("hub_verified"), F.coalesce("h_tags", "l_tags", F.array().cast("array<string>")).alias("tags"),
    )


def is_fresh(cached_at: Column, now: Column, ttl: int = TTL_SECONDS) -> Column:
    """Whether a cache entry is at most ``ttl`` seconds old."""
    return F.unix_timestamp(now) - F.unix_timestamp(cached_at) <= ttl


def doc_types(models: DataFrame) -> DataFrame:
    return models.select("doc_type").orderBy("doc_type")


def model_info(models: DataFrame, doc_type: str) -> DataFrame:
    return models.where(F.col("doc_type") == doc_type)


def available(models: DataFrame) -> DataFrame:
    return models.where(F.col("hub_verified") | (F.col("source") == "local"))


def register(models: DataFrame, more: DataFrame) -> DataFrame:
    """The models with more rows, which replace those of the same type."""
    return models.join(more.select("doc_type"), "doc_type", "left_anti").unionByName(more)


def published(listing: DataFrame, owner: str, model: str = "phobert") -> DataFrame:
    """doc_type, repo_id of an owner's listed repositories that are named like models."""
    from ..functions.text import doc_type_of_repo

    mine = listing.where(F.col("repo_id").startswith(f"{owner}/")).withColumn("doc_type", doc_type_of_repo(F.col("repo_id"), model))
    return mine.where("doc_type IS NOT NULL").select("doc_type", "repo_id").orderBy("doc_type")


def as_of(lookups: DataFrame, entries: DataFrame, on: str, at: str, since: str, ttl: int = TTL_SECONDS, tie: str = "version") -> DataFrame:
    """``lookups`` with ``entry``: the latest of ``entries`` not after a lookup's time and at most ``ttl`` seconds old, or null.

    A sorted merge: both sides are put in order of time together and the last entry
    is carried forward. Time is cut into buckets of ``ttl``; an entry counts in its own
    and in the next, so a lookup finds all that can be fresh in its bucket, and a
    type looked up all the time is dealt over its buckets instead of one task.

    An entry at the very time of a lookup counts; of entries of one time that of the
    largest ``tie`` counts; entries without time or type are never found; lookups
    without time or type, and repeated ones, stay, the former with null. Entries that
    arrive late are no trouble: order is that of ``since``, not of rows.
    """
    names = lookups.columns
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bucket = lambda c: F.floor(micros(c) / (ttl * 1_000_000))
    kind = entries.schema
    none = F.lit(None).cast(kind)
    asked = lookups.select(F.col(on).alias("k"), bucket(at).alias("b"), F.col(at).cast("timestamp").alias("t"), F.lit(1).alias("side"), F.lit(None).cast(kind[tie].dataType).alias("tie"), none.alias("e"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    known = entries.where(F.col(on).isNotNull() & F.col(since).isNotNull())
    both = known.select(F.col(on).alias("k"), F.explode(F.array(bucket(since), bucket(since) + 1)).alias("b"), F.col(since).cast("timestamp").alias("t"), F.lit(0).alias("side"), F.col(tie).alias("tie"), F.struct(*(F.col(f"`{c}`") for c in entries.columns)).alias("e"), F.lit(None).cast(lookups.schema).alias("row"))
    open_ = asked.where(F.col("k").isNull() | F.col("t").isNull()).select("row.*", none.alias("entry"))
    merged = asked.where(F.col("k").isNotNull() & F.col("t").isNotNull()).unionByName(both)
    order = Window.partitionBy("k", "b").orderBy("t", "side", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = merged.withColumn("last", F.last("e", ignorenulls=True).over(order)).where("side = 1")
    fresh = micros("t") - micros(f"last.{since}") <= ttl * 1_000_000
    return last.select("row.*", F.when(fresh, F.col("last")).alias("entry")).unionByName(open_)


def refresh(rows: DataFrame, on: str = "doc_type", since: str = "since", tie: str = "version") -> DataFrame:
    """One row per type: the one of the latest time, of equal times that of the largest ``tie``, nulls last; a partial aggregate, no sort.

    So late rows change nothing unless they are newer, and a refresh over any number of exports gives the same registry.
    """
    names = [c for c in rows.columns if c != on]
    newest = F.max_by(F.struct(*(F.col(f"`{c}`") for c in names)), F.struct(F.col(since).isNotNull(), since, F.col(tie).isNotNull(), tie))
    return rows.where(F.col(on).isNotNull()).groupBy(on).agg(newest.alias("r")).select(on, "r.*")


def export(models: DataFrame, owner: str) -> DataFrame:
    """One JSON object per model with its owner, in the registry's field order."""
    fields = [c for c in models.columns]
    return models.select("doc_type", F.to_json(F.struct(F.lit(owner).alias("owner"), *(F.col(c) for c in fields))).alias("json"))
