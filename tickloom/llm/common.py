"""Helpers of the operators: tables with any columns, intermediate tables, unsigned hashes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Held:
    """A table under private column names, so that clashing names in it can do no harm.

    ``frame`` has columns ``_0``, ``_1``, ...; ``held["text"]`` is the private name of the
    input's column ``text`` (an exact match first, else one that differs in case only).
    """

    def __init__(self, table: DataFrame):
        self.names = list(table.columns)
        self.frame = table.toDF(*(f"_{i}" for i in range(len(self.names))))

    def __getitem__(self, name: str) -> str:
        if name in self.names:
            return f"_{self.names.index(name)}"
        lowered = [x.lower() for x in self.names]
        if name.lower() not in lowered:
            raise ValueError(f"the table has no column {name!r}")
        return f"_{lowered.index(name.lower())}"

    def columns(self) -> list[str]:
        return [f"_{i}" for i in range(len(self.names))]

    def restored(self, frame: DataFrame, added: dict[str, Column], without: str = "") -> DataFrame:
        """The input's columns under their own names, and the added ones; an added column replaces those of its name.

        The column with the private name ``without`` stays out.
        """
        taken = {name.lower() for name in added}
        kept = [i for i, name in enumerate(self.names) if name.lower() not in taken and f"_{i}" != without]
        out = frame.select(*(F.col(f"_{i}") for i in kept), *(column.alias(f"+{name}") for name, column in added.items()))
        return out.toDF(*(self.names[i] for i in kept), *added)


def picked(table: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, as ``new name = old name``."""
    held = Held(table)
    return held.frame.select(*(F.col(held[old]).alias(new) for new, old in columns.items()))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share.

    That is the session's checkpoint folder (``spark.checkpoint.dir``). Only a local
    session, whose tasks run in the driver's process, may go without: it gets a
    temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tickloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: lineage ends there, a lost executor costs nothing."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tickloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
