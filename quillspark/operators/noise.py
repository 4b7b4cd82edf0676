"""OCR noise over characters, entities protected, offsets carried along."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import domain as D
from ..functions.text import locate, pick, uniform

LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def noisy_character(c: Column, u, level: float) -> Column:
    """What one unprotected character becomes; ``u`` gives the draw of a named step. Tried in order: line
    ends lost, look-alikes, marks lost, deletion, then insertion before and spaces doubled or lost."""
    look_alike = None
    for ch, others in D.CONFUSABLE.items():
        look_alike = (F.when if look_alike is None else look_alike.when)(c == ch, pick(list(others), u("which")))
    bare = F.translate(c, D.MARKED, D.UNMARKED)
    spaced = F.when((c == " ") & (u("space") < 0.05 * level), F.when(u("space2") < 0.6, F.lit("  ")).otherwise(F.lit(""))).otherwise(c)
    return (
        F.when((c == "\n") & (u("line") < 0.12 * level), F.when(u("line2") < 0.5, F.lit("")).otherwise(F.lit(" ")))
        .when(c.isin(*D.CONFUSABLE) & (u("alike") < 0.15 * level), look_alike)
        .when((bare != c) & (u("mark") < 0.10 * level), bare)
        .when((c != "\n") & (u("drop") < 0.05 * level), F.lit(""))
        .when(u("insert") < 0.03 * level, F.concat(pick(list(LETTERS), u("letter")), spaced))
        .otherwise(spaced)
    )


def line_noise(text: Column, key: Column, share: float = 0.25, seed: int = 42) -> Column:
    """A stray word before or after a line, for a share of lines."""
    u = lambda s: uniform(seed, key, s)
    token = pick(D.NOISE_TOKENS, u("token"))
    return F.when(u("line") < share, F.when(u("side") < 0.5, F.concat(token, F.lit(" "), text)).otherwise(F.concat(text, F.lit(" "), token))).otherwise(text)


def add_noise(records: DataFrame, key: str, level: float, seed: int = 42, text: str = "text", entities: str = "entities") -> DataFrame:
    """Records with noisy ``text`` and ``entities`` moved with it.

    Each character's replacement is a function of (seed, key, place), so a record
    is rewritten on its own row; nothing is exploded or shuffled.
    """
    level = min(1.0, max(0.0, level))
    if level <= 0:
        return records
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    inside = lambda i: F.exists(entities, lambda e: (i >= e["start"]) & (i < e["end"]))
    new = F.transform(chars, lambda c, i: F.when(inside(i), c).otherwise(noisy_character(c, lambda s: uniform(seed, F.col(key), i, s), level)))
    out = records.withColumn("__new", new)
    at = lambda n: F.length(F.array_join(F.slice("__new", F.lit(1), n), ""))
    moved = F.transform(entities, lambda e: F.struct(e["label"].alias("label"), at(e["start"]).alias("start"), (at(e["start"]) + e["end"] - e["start"]).alias("end"), e["value"].alias("value")))
    return out.withColumns({text: F.array_join("__new", ""), entities: moved}).drop("__new")


def add_noise_tokens(records: DataFrame, key: str, level: float, seed: int = 42, text: str = "text", entities: str = "entities") -> DataFrame:
    """Stray words before or after lines, in half of the documents at level 1; spans are found again by
    ordered search and keep their old place where they are not found."""
    hit = uniform(seed, F.col(key), "noise") < 0.5 * level

    def line(x: Column, i: Column) -> Column:
        u = lambda s: uniform(seed, F.col(key), i, s)
        token = pick(D.NOISE_TOKENS, u("token"))
        return F.when((F.trim(x) != "") & (u("line") < 0.25 * level), F.when(u("side") < 0.5, F.concat(token, F.lit(" "), x)).otherwise(F.concat(x, F.lit(" "), token))).otherwise(x)

    out = records.withColumn("__new", F.when(hit, F.array_join(F.transform(F.split(text, "\n", -1), line), "\n")).otherwise(F.col(text)))
    start = F.struct(F.lit(1).alias("pos"), F.array().cast("array<struct<label:string,start:int,end:int,value:string>>").alias("out"))

    def step(acc: Column, e: Column) -> Column:
        at = locate(e["value"], F.col("__new"), acc["pos"])
        moved = F.when(at > 0, F.struct(e["label"].alias("label"), (at - 1).alias("start"), (at - 1 + F.length(e["value"])).alias("end"), e["value"].alias("value"))).otherwise(e)
        return F.struct(F.when(at > 0, at + F.length(e["value"])).otherwise(acc["pos"]).alias("pos"), F.concat(acc["out"], F.array(moved)).alias("out"))

    found = F.aggregate(entities, start, step)["out"]
    return out.withColumns({entities: F.when(hit, found).otherwise(F.col(entities)), text: F.col("__new")}).drop("__new")
