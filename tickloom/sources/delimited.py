"""Delimited price files of unknown layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources import folder as folders
from tickloom.sources import order
from tickloom.sources.folder import FolderScan, NoInput, read_folder

__all__ = ["FolderScan", "NoInput", "latest_file", "line_separators", "parse_lines", "probed_file", "read_file", "read_folder", "separator_by_count"]


def separator_by_count(header: Column) -> Column:
    """The counting rule as a column, for lines that are already in a DataFrame."""
    semicolons, commas = F.regexp_count(header, F.lit(";")), F.regexp_count(header, F.lit(","))
    return F.when(semicolons >= commas, ";").otherwise(",")


def line_separators(lines: DataFrame, path: str, place: str, text: str) -> DataFrame:
    """(path, separator) from lines with their file and place: the counting rule on each
    file's first line, found by a partial aggregate."""
    first = lines.groupBy(F.col(path).alias("path")).agg(F.min_by(text, place).alias("header"))
    return first.select("path", separator_by_count(F.col("header")).alias("separator"))


def latest_file(spark: SparkSession, folder: str, suffix: str = ".csv") -> str:
    """Path of the most recently modified file, the last path on ties."""
    files = folders.listed_files(spark, folder, folders.glob_of(suffix))
    newest = files.orderBy(F.desc("modified"), F.desc("path")).limit(1).collect()
    if not newest:
        raise NoInput(f"no {suffix} file in {folder}")
    return newest[0]["path"]


def probed_file(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """One file's full path, and its separator by the vote over its first lines; none if it has no line but blank ones."""
    found = folders.layouts(folders.listed_files(spark, path, "*")).collect()
    return (found[0]["path"], found[0]["separator"]) if found else (path, None)


def read_file(spark: SparkSession, path: str, sep: str = "auto", lower_names: bool = False) -> DataFrame:
    """One delimited file, every column text, with its input order columns."""
    if sep == "auto":
        sep = probed_file(spark, path)[1]
        if sep is None:
            raise NoInput(f"{path} is empty")
    reader = spark.read.option("header", True).option("sep", sep).option("inferSchema", False)
    table = order.with_order(reader.csv(path))
    names = [name.strip() for name in table.columns]
    return table.toDF(*[name.lower() if lower_names else name for name in names])


def parse_lines(lines: DataFrame, text: str, columns: Sequence[str], separator: str) -> DataFrame:
    """Text lines of one known layout to text columns, beside the other columns of the frame."""
    schema = ", ".join(f"`{name}` string" for name in columns)
    parsed = F.from_csv(F.col(text), schema, {"sep": separator})
    return lines.withColumn("_parsed", parsed).select(
        *[name for name in lines.columns if name != text], "_parsed.*"
    )
