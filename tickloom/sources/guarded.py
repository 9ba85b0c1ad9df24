"""A table written under expectations: rows are read, judged, counted and written in one action.

Good rows and diverted ones go to two folders of a draft beside the table; the counts are
observed in the tasks that write. Only when no rejecting expectation is broken do the two
folders take their places by rename, so that a rejected table leaves what stood there before.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tickloom.operators.expectations import DIVERTED, KEPT, Expectation, Finding, counts, findings, judged


class Rejected(ValueError):
    """Rows break an expectation under which the whole table isn't taken; nothing was published."""

    def __init__(self, found: list[Finding]):
        self.findings = found
        worst = [f"{x.name} ({x.rows} rows)" for x in found if x.action == "reject" and x.rows]
        super().__init__("rejected: " + ", ".join(worst))


@dataclass(frozen=True)
class Written:
    """What a guarded write did: rows read, rows put into quarantine, and rows that break each expectation."""

    path: str
    quarantine: str
    rows: int
    diverted: int
    findings: list[Finding]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(x.name, x.action, x.rows) for x in self.findings], "name string, action string, rows bigint")


def _replace(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> None:
    """Put each draft folder into its place. What stands there moves aside first and comes back if a later step fails."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(pairs[0][1]).getFileSystem(spark._jsc.hadoopConfiguration())
    done = []
    try:
        for draft, target in pairs:
            aside = f"{target}.before-{uuid.uuid4().hex}"
            had = files.exists(path(target)) and files.rename(path(target), path(aside))
            done.append((target, aside if had else None))
            if not files.exists(path(draft)):  # no row of this kind
                files.mkdirs(path(draft))
            files.mkdirs(path(target).getParent())
            if not files.rename(path(draft), path(target)):
                raise OSError(f"{draft} could not be renamed to {target}")
    except Exception:
        for target, aside in reversed(done):
            files.delete(path(target), True)
            if aside:
                files.rename(path(aside), path(target))
        raise
    for _, aside in done:
        if aside:
            files.delete(path(aside), True)


def write(
    table: DataFrame, path: str, expectations: Sequence[Expectation], quarantine: str | None = None, by: Sequence[str] = ()
) -> Written:
    """Write the rows that keep the expectations to ``path``, the diverted ones to ``quarantine``.

    ``quarantine`` (``path`` with ``_quarantine`` at its end if not given) has one column
    more, ``broken``; ``path`` has the table's columns. Both are Parquet, partitioned by
    ``by``, and replace what stood there. Raises ``Rejected`` when a rejecting expectation is broken.

    Counts come from the tasks of the write itself, each of which counts once however often
    it was tried. An empty table keeps all expectations and makes two empty folders.
    """
    spark = table.sparkSession
    quarantine = quarantine or f"{path}_quarantine"
    draft = f"{path}.draft-{uuid.uuid4().hex}"
    watch = Observation()
    rows = judged(table, expectations).observe(watch, *counts(expectations))
    rows = rows.withColumn("broken", F.when(F.col("standing") == DIVERTED, F.col("broken")))
    name = spark._jvm.org.apache.hadoop.fs.Path
    files = name(draft).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        rows.write.partitionBy("standing", *by).parquet(draft)
        found = findings(expectations, watch.get)
        if any(x.action == "reject" and x.rows for x in found):
            raise Rejected(found)
        _replace(spark, [(f"{draft}/standing={KEPT}", path), (f"{draft}/standing={DIVERTED}", quarantine)])
    finally:
        files.delete(name(draft), True)
    return Written(path, quarantine, watch.get["rows"], watch.get["diverted"], found)


def read(table: DataFrame, path: str, quarantined: bool = False) -> DataFrame:
    """The rows at ``path`` under the columns of ``table``, and ``broken`` for those in quarantine."""
    further = [StructField("broken", ArrayType(StringType()))] if quarantined else []
    schema = StructType([*table.schema.fields, *further])
    return table.sparkSession.read.schema(schema).parquet(path).select(*(f"`{field.name}`" for field in schema))
