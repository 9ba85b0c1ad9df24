"""Ranks over a whole table, however large and however many of its rows are equal.

No task sees more than a range of the rows: they are range partitioned by a total order, each
partition numbers its own rows, and a prefix sum over the partitions' counts (one row per
partition) shifts these numbers to ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.sources.shared import stored

# Fixed by Spark: a running id holds the partition above this bit, the place in it below.
_PLACE_BITS = 33


def in_order(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows as a written table in total order, with ``_at``: partition and place in it.

    Rows that are equal in every column are told apart by an id, so a value that most rows
    share spreads over many partitions. Ids are written before they are used: a task that
    runs again finds the same ones, and no row is lost or doubled.
    """
    columns = [*order, *(c for c in rows.columns if c not in order)]
    told_apart = stored(rows.withColumn("_id", F.monotonically_increasing_id()), "unranked")
    total_order = [*(F.col(c).asc_nulls_first() for c in columns), F.col("_id")]
    placed = told_apart.repartitionByRange(*total_order).sortWithinPartitions(*total_order).drop("_id")
    return stored(placed.withColumn("_at", F.monotonically_increasing_id()), "placed")


def ranked(rows: DataFrame, order: Sequence[str], rank: str = "rank") -> DataFrame:
    """The rows with their ``rank`` from 1 up, by ``order`` and then by all other columns, nulls first."""
    placed = in_order(rows, order)
    part = F.shiftrightunsigned("_at", _PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(shifts), "_part")  # one row per partition
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    return joined.select(*rows.columns, (F.col("_before") + place + 1).alias(rank))
