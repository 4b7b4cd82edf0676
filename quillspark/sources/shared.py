"""Where queries put the tables they write and read again: a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints; the session's ``spark.checkpoint.dir`` where it is set.

    Only a local session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    context = sc._jsc.sc()
    if not context.getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="quillspark-checkpoint-"))
    return f"{context.getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
