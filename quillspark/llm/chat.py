"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

For every participant of a dialogue the whole dialogue is rendered with that
speaker as ``assistant`` and everyone else as a named user; instructions of the
roles in ``NEUTRAL`` stay system turns and are nobody's perspective. The mask of a
turn covers exactly what the assistant says in it (its text and the closing
tag), so each perspective trains on one speaker.

Rows are rendered turns, not whole dialogues: a dialogue of any length never has
to fit into one row or task. Offsets into the rendered dialogue are prefix sums
in two steps, within blocks of ``BLOCK_TURNS`` turns and over the blocks, so a
dialogue that holds a third of all turns is spread over many tasks, also where
its turns meet its participants. A tag inside a text or role is broken by a space
(``<| im_``), so that it cannot open or close a turn.

Nulls and odd rows: turns are ordered by turn, role, text, nulls first, so ties
and repeated rows have a place; a null text is empty; a null role speaks as
``unknown``; a null conv_id is a dialogue of its own; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spread import spread_join

NEUTRAL = ("system",)
OPEN, SAY, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TAG, BROKEN_TAG = "<|im_", "<| im_"
BLOCK_TURNS = 256


def plain(text: Column) -> Column:
    """A text whose tags, if it holds any, cannot open or close a turn."""
    return F.replace(text, F.lit(TAG), F.lit(BROKEN_TAG))


def rotate_perspectives(turns: DataFrame) -> DataFrame:
    """conv_id, perspective, turn, n_same (rank among rows with this turn number), rendered, start, end,
    mask_start, mask_end: offsets in code points into the dialogue as this perspective renders it, end
    exclusive; null masks for turns the perspective does not speak."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        plain(F.coalesce(F.col("role").cast("string"), F.lit("unknown"))).alias("role"), plain(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"),
    )
    rows = rows.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 60))))
    roles = rows.groupBy("conv", "role").agg(F.count("*").alias("n")).withColumn("n", F.sum("n").over(Window.partitionBy("conv")))
    speakers = roles.where(~F.col("role").isin(*NEUTRAL)).select("conv", F.col("role").alias("perspective"), "n")
    # each turn once per perspective: participants are few, turns may be many
    seen = spread_join(rows, speakers, ["conv"], "n", ["block"])
    named = F.when(F.col("role").isin(*NEUTRAL), F.col("role")).when(F.col("role") == F.col("perspective"), F.lit("assistant")).otherwise(F.concat(F.lit("user name="), F.col("role")))
    head = F.concat(F.lit(OPEN), named, F.lit(SAY))
    body = F.concat(F.col("text"), F.lit(CLOSE))
    seen = seen.withColumn("rendered", F.concat(head, body)).withColumn("head", F.length(head).cast("long")).withColumn("size", F.length("rendered").cast("long"))
    sizes = seen.groupBy("conv", "perspective", "block").agg(F.sum("size").alias("sum"))
    before = Window.partitionBy("conv", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv", "perspective", "block", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    ordered = Window.partitionBy("conv", "perspective", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    inside = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("conv", "perspective", "block", "turn").orderBy("role", "text")
    placed = seen.withColumn("end_in", F.sum("size").over(inside)).withColumn("n_same", F.row_number().over(same).cast("long"))
    placed = placed.join(offsets, ["conv", "perspective", "block"])
    start, end = F.col("base") + F.col("end_in") - F.col("size"), F.col("base") + F.col("end_in")
    own = F.col("role") == F.col("perspective")
    return placed.select("conv_id", "perspective", "turn", "n_same", "rendered", start.alias("start"), end.alias("end"), F.when(own, start + F.col("head")).alias("mask_start"), F.when(own, end).alias("mask_end"))


CHAT_SQL = """
WITH rows AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, replace(coalesce(role, 'unknown'), '<|im_', '<| im_') AS role, replace(coalesce(text, ''), '<|im_', '<| im_') AS text FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id, role AS perspective FROM rows WHERE role <> 'system'
), seen AS (
  SELECT r.*, perspective,
         '<|im_start|>' || CASE WHEN role = 'system' THEN role WHEN role = perspective THEN 'assistant' ELSE 'user name=' || role END || chr(10) AS head
  FROM rows r JOIN speakers s ON r.conv_id IS NOT DISTINCT FROM s.conv_id
), rendered AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM seen
), placed AS (
  SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS e,
         row_number() OVER (PARTITION BY conv_id, perspective, turn ORDER BY role, text) AS n_same
  FROM rendered
)
SELECT conv_id, perspective, turn, n_same, rendered, CAST(e - length(rendered) AS BIGINT) AS start, CAST(e AS BIGINT) AS "end",
       CASE WHEN role = perspective THEN CAST(e - length(rendered) + length(head) AS BIGINT) END AS mask_start,
       CASE WHEN role = perspective THEN CAST(e AS BIGINT) END AS mask_end
FROM placed
"""
