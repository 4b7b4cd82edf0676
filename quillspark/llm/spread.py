"""Joins whose hot keys are split over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_ROWS = 16_384
MOST_HEAVY = 100_000


def spread_join(rows: DataFrame, keyed: DataFrame, on: list[str], n: str, by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``keyed``, whose column ``n`` counts the rows of each key.

    Keys of more than ``HEAVY_ROWS`` rows are dealt by a hash of ``by`` to as many
    salts as they fill, their side of ``keyed`` repeated for each. At most
    ``MOST_HEAVY`` keys count as heavy (the bound rises with the rows), so the
    table of them is small enough for a broadcast whatever the data. ``keyed`` is
    read three times; settle it first where it is costly. Null keys match nothing.
    ``how``: inner, or left, which keeps rows without a partner.
    """
    total = keyed.select(*on, n).distinct().agg(F.sum(n)).first()[0] or 0
    bound = max(HEAVY_ROWS, total // MOST_HEAVY)
    salts = F.ceil(F.col(n) / bound).cast("int")
    heavy = keyed.where(F.col(n) > bound).select(*on, salts.alias("__salts")).distinct()
    dealt = rows.join(F.broadcast(heavy), on, "left").withColumn("__salt", F.pmod(F.xxhash64(*by), F.coalesce("__salts", F.lit(1))).cast("int")).drop("__salts")
    repeated = keyed.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop(n)
    return dealt.join(repeated, [*on, "__salt"], how).drop("__salt")
