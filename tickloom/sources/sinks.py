"""Writers. Output is a directory of part files unless one named file is asked for, which
one task then writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import dates
from tickloom.functions.names import slug_text
from tickloom.sources.shared import stored

# Header names of exported train and test tables, and the test metrics kept.
EXPORT_NAMES = {"symbol": "ticker", "date": "data", "close": "fechamento", "low": "mínima", "high": "máxima", "volume": "volume"}
TEST_METRICS = (
    "train_r2", "test_r2", "target_r2_min", "target_r2_max", "train_target_reached", "test_target_reached",
    "target_reached", "rmse", "mae", "epochs", "iterations",
)


def write_parquet(table: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite") -> str:
    table.write.mode(mode).partitionBy(*by).parquet(path)
    return path


def write_csv(table: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    table.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    return path


def write_single(table: DataFrame, target: str, kind: str, sep: str = ";") -> str:
    """One file with exactly the name ``target``: the table goes through one task and its
    part file is renamed by the file system. An earlier file of that name stays until the
    new one is complete, and comes back if the rename fails."""
    spark = table.sparkSession
    staging = f"{target}.parts"
    if kind == "csv":
        write_csv(table.coalesce(1), staging, sep)
    else:
        write_parquet(table.coalesce(1), staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = system.globStatus(path(f"{staging}/part-*.{kind}"))
    if len(parts) != 1:
        raise FileNotFoundError(f"expected one part file in {staging}, found {len(parts)}")
    aside = f"{target}.before"
    system.delete(path(aside), True)
    had = system.exists(path(target)) and system.rename(path(target), path(aside))
    if not system.rename(parts[0].getPath(), path(target)):
        if had:
            system.rename(path(aside), path(target))
        raise OSError(f"{parts[0].getPath()} could not be renamed to {target}")
    system.delete(path(aside), True)
    system.delete(path(staging), True)
    return target


def symbol_bucket(symbol: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("int")


def write_by_symbol(table: DataFrame, path: str, buckets: int = 0, day: str = "trade_date_fmt") -> str:
    """Parquet in one folder per symbol, or per hash bucket of symbols when there are too
    many for folders. Rebalancing evens the files out, also where one symbol has most rows,
    and the order inside a file lets row groups be skipped by symbol and day."""
    by = "symbol"
    if buckets:
        by = "symbol_bucket"
        table = table.withColumn(by, symbol_bucket(F.col("symbol"), buckets))
    return write_parquet(table.hint("rebalance", by).sortWithinPartitions(by, "symbol", day), path, [by])


def write_buckets(table: DataFrame, path: str, day: str = "trade_date_fmt") -> str:
    """Rows that carry their ``symbol_bucket``, each bucket they fall into written anew; the folders of others are not touched."""
    ordered = table.hint("rebalance", "symbol_bucket").sortWithinPartitions("symbol_bucket", "symbol", day)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol_bucket").parquet(path)
    return path


def publish(table: DataFrame, root: str, prefix: str, source_name: str, by: Sequence[str] = ()) -> str:
    """Parquet at ``root/prefix/slug.parquet``; the root may be any Hadoop URI."""
    return write_parquet(table, f"{root.rstrip('/')}/{prefix}/{slug_text(source_name)}.parquet", by)


def for_display(table: DataFrame) -> DataFrame:
    return table.withColumn("date", dates.display_date(F.col("date")))


def write_display_csv(table: DataFrame, folder: str, source_name: str, stamp: str) -> str:
    """Treated series with dd/MM/yyyy dates, named after the source and the time stamp."""
    return write_csv(for_display(table), f"{folder}/{slug_text(source_name)}_tratado_{stamp}.csv", ";")


def export_names(table: DataFrame) -> DataFrame:
    """Ticker, date, close, low, high, volume under their export headers."""
    return table.select(*[F.col(name).alias(header) for name, header in EXPORT_NAMES.items()])


def write_forecast(forecast, keys: DataFrame, root: str, mode: str = "append") -> dict[str, str]:
    """All artifacts of a forecast run as tables that carry symbol and ``run_key``.

    ``keys`` maps each symbol to the key of its run. Metrics are JSON, attempts and
    predictions CSV, and the train and test rows Parquet.
    """
    # A row per symbol, read by every artifact: written once, what it is made of isn't made again for each.
    keys = stored(keys.select("symbol", "run_key"), "run-keys")

    def keyed(table: DataFrame) -> DataFrame:
        return table.join(keys, "symbol")

    paths = {
        name: f"{root.rstrip('/')}/{name}"
        for name in (
            "training_search", "training_metrics", "test_predictions", "future_predictions", "test_metrics",
            "train_parquet", "test_parquet",
        )
    }
    metrics = keyed(forecast.metrics).persist()  # two small tables come from this one
    try:
        write_csv(keyed(forecast.attempts), paths["training_search"], mode=mode)
        metrics.write.mode(mode).option("ignoreNullFields", False).json(paths["training_metrics"])
        metrics.select("symbol", "run_key", *TEST_METRICS).write.mode(mode).option("ignoreNullFields", False).json(
            paths["test_metrics"]
        )
    finally:
        metrics.unpersist()
    write_csv(keyed(forecast.past), paths["test_predictions"], mode=mode)
    write_csv(keyed(forecast.future), paths["future_predictions"], mode=mode)
    rows = keyed(forecast.rows)
    for part in ("train", "test"):
        own = rows.where(F.col("part") == part)
        renamed = own.select(*[F.col(n).alias(h) for n, h in EXPORT_NAMES.items()], "run_key")
        write_parquet(renamed, paths[f"{part}_parquet"], mode=mode)
    return paths
