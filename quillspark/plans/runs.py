"""Runs over many document types as a table: a ledger of attempts, and the next step of every type derived from it.

Nothing is held in the driver's memory between steps: what has been done is what
the ledger says, so a run that broke off is simply started again and goes on where
each type stood. Steps of different types are done together, as one DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The steps in order; a type ends where a step has failed for good, or after the last.
STEPS = ("generate", "train", "evaluate", "publish")
LEDGER = "doc_type string, step string, attempt int, ok boolean, value double, error string"
ATTEMPTS = 2
LEAST_F1 = 0.2


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The attempts so far. A repeated row (an append that was done twice) counts once."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path).groupBy("doc_type", "step", "attempt").agg(F.max("ok").alias("ok"), F.max("value").alias("value"), F.max("error").alias("error"))


def progress(types: DataFrame, done: DataFrame, attempts: int = ATTEMPTS) -> DataFrame:
    """doc_type, step (the next one; null when the type has ended), attempt, failed (where it ended), f1."""
    place = F.array_position(F.array(*map(F.lit, STEPS)), F.col("step"))
    tried = done.groupBy("doc_type", "step").agg(F.max("ok").alias("ok"), F.max("attempt").alias("attempt"), F.max(F.when(F.col("ok"), F.col("value"))).alias("value"))
    state = tried.groupBy("doc_type").agg(
        F.max(F.when(F.col("ok"), place)).alias("passed"), F.max(F.when(~F.col("ok"), F.struct(place.alias("at"), "step", "attempt"))).alias("stuck"), F.max(F.when(F.col("step") == "evaluate", F.col("value"))).alias("f1"),
    )
    rows = types.select("doc_type").distinct().join(state, "doc_type", "left")
    passed = F.coalesce("passed", F.lit(0))
    retried = F.col("stuck.at") > passed
    over = retried & (F.col("stuck.attempt") >= attempts)
    low = (F.col("f1") < LEAST_F1) & (passed == STEPS.index("evaluate") + 1)
    following = F.get(F.array(*map(F.lit, STEPS)), passed.cast("int"))
    return rows.select("doc_type", F.when(~F.coalesce(over, F.lit(False)) & ~F.coalesce(low, F.lit(False)), following).alias("step"), (F.when(retried, F.col("stuck.attempt")).otherwise(0) + 1).cast("int").alias("attempt"), F.when(over, F.col("stuck.step")).when(low, F.lit("low_f1")).alias("failed"), "f1")


def run_types(types: DataFrame, path: str, execute: Callable[[DataFrame], DataFrame], attempts: int = ATTEMPTS, rounds: int | None = None) -> DataFrame:
    """doc_type, status, f1, n_attempts once no type has a step left.

    ``execute`` takes rows (doc_type, step, attempt) and gives (doc_type, ok, value,
    error). The rounds are at most the steps times the attempts, however many types;
    ``rounds``: stop after so many, as a run does that breaks off.
    """
    spark = types.sparkSession
    for _ in range(len(STEPS) * attempts if rounds is None else rounds):
        due = progress(types, ledger(spark, path), attempts).where("step IS NOT NULL").select("doc_type", "step", "attempt")
        if due.isEmpty():
            break
        results = execute(due)
        due.join(results, "doc_type").select("doc_type", "step", "attempt", F.coalesce("ok", F.lit(False)).alias("ok"), F.col("value").cast("double").alias("value"), "error").write.mode("append").parquet(path)
    return summary(types, ledger(spark, path), attempts)


def summary(types: DataFrame, done: DataFrame, attempts: int = ATTEMPTS) -> DataFrame:
    """How every type stands, with its number of attempts: published, running, low_f1, or the step that failed."""
    rows = progress(types, done, attempts).join(done.groupBy("doc_type").agg(F.count("*").alias("n_attempts")), "doc_type", "left")
    status = F.when(F.col("failed") == "low_f1", F.lit("low_f1")).when(F.col("failed").isNotNull(), F.concat("failed", F.lit("_failed"))).when(F.col("step").isNull(), F.lit("published")).otherwise("running")
    return rows.select("doc_type", status.alias("status"), "f1", F.coalesce("n_attempts", F.lit(0)).alias("n_attempts"))
