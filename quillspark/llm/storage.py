"""Where the operators cut lineage: the shared checkpoint folder of the cluster."""

from __future__ import annotations

import gc
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would lose data, so there it is an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="quillspark-checkpoint-"))


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application's checkpoints, for tables beside them."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


ROWS_PER_FILE = 250_000


def settle(df: DataFrame, most: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    A lost executor then costs a re-read, not a re-run of the phases before.
    ``most``: a known bound on its (narrow) rows, by which few rows go to few files.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if most is not None:
        df = df.coalesce(most // ROWS_PER_FILE + 1)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and checkpoints that nothing refers to any more.

    Python's references to JVM objects are dropped by a thread of their own, a
    moment after its garbage collection, so the JVM's collection comes after that.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()
