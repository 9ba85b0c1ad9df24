"""The folder that driver and executors share, and intermediate results kept there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder (``spark.checkpoint.dir``).

    A local session, whose tasks run in the driver's process, may go without: it gets a
    folder of its own. On a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tickloom-")
        context.setCheckpointDir(folder)
    return folder


def materialised(frame: DataFrame) -> DataFrame:
    """The frame's rows, computed once and kept by a reliable checkpoint."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tickloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table of the shared folder; unlike a checkpoint it can be pruned by column and filter."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
