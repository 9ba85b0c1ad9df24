"""Input order of scanned rows.

Spark packs files into tasks by size, so a running id alone does not follow file order.
The order of a row is (file, start of its block, running id inside the task); the first
two are also the coarse ``block`` that bounds how many rows share it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = ["_file", "_block_start", "_row"]


def with_order(scan: DataFrame) -> DataFrame:
    """Add the order columns. Call directly on a file scan, before any shuffle."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row"),
    )


def block() -> Column:
    return F.struct("_file", "_block_start")
