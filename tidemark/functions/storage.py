"""Intermediate results in the folder that a cluster's machines share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The reliable checkpoint folder of the session.

    A cluster names a shared folder in spark.checkpoint.dir. Where none is set, a local session takes a temporary folder, as in
    tests, and any other a folder in the warehouse, which its machines share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """`df`, computed once and written to the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def compact(df: DataFrame, each: int = 10_000) -> DataFrame:
    """`df`, checkpointed, in a task for so many rows: a fit's hundreds of small jobs then start no more tasks than the rows need."""
    rows = checkpointed(df)
    return rows.coalesce(max(1, -(-rows.count() // each)))
