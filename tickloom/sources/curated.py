"""Tables written by the curation job: read, pruned by symbol and day, and updated bucket by bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import series
from tickloom.sources import sinks
from tickloom.sources.shared import stored
from tickloom.sources.sinks import symbol_bucket


def read_curated(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """Curated Parquet with ``trade_date_fmt`` as a real date. Ask for ``ordered`` only at
    a sink; every operator states the order it needs itself."""
    table = spark.read.parquet(path).withColumn("trade_date_fmt", F.try_to_date("trade_date_fmt", "yyyy-MM-dd"))
    return table.orderBy("symbol", "trade_date_fmt") if ordered else table


def of_symbols(table: DataFrame, symbols: Sequence[str], buckets: int = 0) -> DataFrame:
    """Rows of some symbols. With the bucket number the table was written with, only those
    symbols' bucket folders are read."""
    rows = table.where(F.col("symbol").isin(*symbols))
    if buckets:
        rows = rows.where(F.col("symbol_bucket").isin(*[symbol_bucket(F.lit(s), buckets) for s in symbols]))
    return rows


def history(spark: SparkSession, path: str, tickers: Sequence[str], start, end, buckets: int, day: str = "trade_date_fmt") -> DataFrame:
    """Rows of the tickers from ``start`` to ``end``, both days included, ``day`` as a date.

    Tickers are trimmed and upper-cased. Only their buckets' folders are listed, and in the
    files, which are ordered by symbol and day, only row groups that can hold such rows: the
    days are compared as they are stored, as ISO text.
    """
    wanted, first, last = series.history_bounds(tickers, start, end)
    rows = of_symbols(spark.read.parquet(path), wanted, buckets).where((F.col(day) >= first) & (F.col(day) <= last))
    return rows.drop("symbol_bucket").withColumn(day, F.try_to_date(day, "yyyy-MM-dd"))


def update(new: DataFrame, path: str, buckets: int, day: str = "trade_date_fmt") -> list[int]:
    """Put new rows into a table of ``sinks.write_by_symbol``: they replace the rows of their symbols and days.

    Only buckets that new rows fall into are read and written again, all others stay as
    they are; the touched ones are returned. What the buckets shall hold is written
    elsewhere first, so that nothing is overwritten while it is read.
    """
    spark = new.sparkSession
    fresh = stored(new.withColumn("symbol_bucket", symbol_bucket(F.col("symbol"), buckets)), "update")
    touched = sorted(row[0] for row in fresh.select("symbol_bucket").distinct().collect())  # at most ``buckets`` numbers
    old = spark.read.parquet(path).where(F.col("symbol_bucket").isin(touched))
    keys = fresh.select(F.col("symbol").alias("_symbol"), F.col(day).alias("_day")).distinct()
    replaced = F.col("symbol").eqNullSafe(F.col("_symbol")) & F.col(day).eqNullSafe(F.col("_day"))
    merged = stored(old.join(keys, replaced, "left_anti").unionByName(fresh.select(old.columns)), "merged")
    sinks.write_buckets(merged, path, day)
    return touched
