"""A folder of delimited files in any number of layouts, as one scan.

Only the head of each file is looked at beforehand, in tasks: it gives the file's separator, by a
vote over its lines, and its column names. The result is a table with one row per file, which the
lines are joined with by their file. So neither files nor layouts are listed in the driver, and
the plan grows with the number of different column names only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import quality
from tickloom.sources import fixedwidth, order
from tickloom.sources.shared import stored

# Accepted separators and how much of a file decides between them.
SEPARATORS = ";,"
SAMPLE_CHARACTERS = 4096
# Folders that are listed by tasks become this many tasks a core, not a task each.
LISTING_TASKS = 4
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

_LINE_END = r"\r\n|\r|\n"
_QUOTED = '"[^"]*"'
_OUTSIDE_QUOTES = '(?=(?:[^"]*"[^"]*")*[^"]*$)'
_MARK = "\ufeff"


class NoInput(FileNotFoundError):
    """A folder holds no file that could be read."""


def _marks(line: Column, mark: str) -> Column:
    bare = F.regexp_replace(line, _QUOTED, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(mark), F.lit("")))


def _winner(least: dict[str, Column], most: dict[str, Column], total: dict[str, Column]) -> Column:
    """The separator that every line holds equally often; of two such, or none, the more frequent one, ``;`` at ties."""
    even = {mark: (least[mark] == most[mark]) & (most[mark] > 0) for mark in SEPARATORS}
    more_commas = F.when(total[","] > total[";"], ",").otherwise(";")
    return F.when(even[";"] & ~even[","], ";").when(even[","] & ~even[";"], ",").otherwise(more_commas)


def _counts(lines: Column, mark: str) -> Column:
    return F.transform(lines, lambda x: _marks(x, mark))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often the body uses it (a one-element transform)."""
    return F.transform(F.array(value), body).getItem(0)


def voted_separator(lines: Column) -> Column:
    """Separator of a sample given as an array of lines. Separators inside double quotes do not count."""

    def vote(found: Column) -> Column:
        least, most, total = ({m: found.getField(f"{name}{i}") for i, m in enumerate(SEPARATORS)} for name in ("least", "most", "total"))
        return F.when(found.getField("lines") == 0, ";").otherwise(_winner(least, most, total))

    def counted(filled: Column) -> Column:
        counts = [_counts(filled, m) for m in SEPARATORS]
        kinds = {"least": F.array_min, "most": F.array_max, "total": lambda x: F.aggregate(x, F.lit(0), lambda a, b: a + b)}
        found = [_once(c, lambda x: F.struct(*[f(x).alias(name) for name, f in kinds.items()])) for c in counts]
        parts = [found[i].getField(name).alias(f"{name}{i}") for i in range(len(found)) for name in kinds]
        return F.struct(F.size(filled).alias("lines"), *parts)

    return _once(_once(F.filter(lines, lambda x: F.trim(x) != ""), counted), vote)


def voted_separators(lines: DataFrame, path: str, text: str) -> DataFrame:
    """(path, separator, lines) by the same vote over lines in a DataFrame, as a partial aggregate: no file's lines meet in a task."""
    counted = lines.where(F.trim(text) != "").select(F.col(path).alias("path"), *(_marks(F.col(text), m).alias(f"_{i}") for i, m in enumerate(SEPARATORS)))
    sums = [f(f"_{i}").alias(f"_{name}{i}") for i in range(len(SEPARATORS)) for name, f in (("least", F.min), ("most", F.max), ("total", F.sum))]
    votes = counted.groupBy("path").agg(F.count(F.lit(1)).alias("lines"), *sums)
    least, most, total = ({m: F.col(f"_{name}{i}") for i, m in enumerate(SEPARATORS)} for name in ("least", "most", "total"))
    return votes.select("path", _winner(least, most, total).alias("separator"), "lines")


def glob_of(suffix: str) -> str:
    """A file name pattern for a suffix in any case."""
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """While files are listed, each listing task takes many folders: by default it takes one of up to 10,000."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def listed_files(spark: SparkSession, folder: str, pattern: str, recursive: bool = False) -> DataFrame:
    """(path, file, modified, length): path as files are opened, file as scans name it; contents are not read.
    Spark never lists files of zero length."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    with _listing(spark):
        files = reader.load(folder)
    return files.select(
        "path", F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("modified"), "length"
    )


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    uri = path.replace("s3a://", "s3://", 1)
    uri = "file://" + uri[len("file:") :] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    if uri.startswith("file://"):  # the path is as it stands on disk, not escaped
        return fs.LocalFileSystem(), uri[len("file://") :]
    return fs.FileSystem.from_uri(uri)


def _heads(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first characters of each file, the whole first line that is not blank among them."""
    for batch in batches:
        found = []
        for path in batch["path"]:
            system, inner = file_system(path)
            with system.open_input_stream(inner, compression=None) as stream:
                # Up to four bytes a character cover the sample in any UTF-8 text.
                data = stream.read(4 * SAMPLE_CHARACTERS)
                while not {b"\n"[0], b"\r"[0]} & set(data.lstrip(b"\xef\xbb\xbf \t\r\n")) and (more := stream.read(4 * SAMPLE_CHARACTERS)):
                    data += more
            found.append(data.decode("utf-8-sig", errors="replace"))
        yield pd.DataFrame({"path": batch["path"], "file": batch["file"], "head": found})


def layouts(files: DataFrame, sep: str = "auto") -> DataFrame:
    """(path, file, separator, header, names) per file from its head; nulls where a file has no line but blank ones."""
    heads = files.select("path", "file").mapInPandas(_heads, "path string, file string, head string")
    lines = F.split(F.substring("head", 1, SAMPLE_CHARACTERS), _LINE_END)
    cut = (F.length("head") > SAMPLE_CHARACTERS) & (F.size(lines) > 1)  # the sample's last line is not whole
    sample = F.when(cut, F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    header = F.get(F.filter(F.split("head", _LINE_END), lambda x: F.trim(x) != ""), F.lit(0))
    separator = voted_separator(sample) if sep == "auto" else F.lit(sep)
    found = heads.withColumn("header", header).withColumn("separator", F.when(F.col("header").isNotNull(), separator))
    marks = SEPARATORS if sep == "auto" else [sep]
    parts = [F.when(F.col("separator") == m, F.split("header", _literal(m) + _OUTSIDE_QUOTES)) for m in marks]
    bare = lambda x: F.replace(F.regexp_replace(F.trim(x), '^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))
    named = F.transform(F.coalesce(*parts), lambda x, i: F.when(F.trim(bare(x)) == "", F.concat(F.lit("_c"), i)).otherwise(F.trim(bare(x))))
    return found.select("path", "file", "separator", "header", named.alias("names"))


def _literal(mark: str) -> str:
    return "\\" + mark if mark in "\\|.^$*+?()[]{}" else mark


def columns_of(found: DataFrame) -> tuple[list[str], int]:
    """The different column names in order of first appearance, and the most columns of a file. Names differ by more than case."""
    cells = found.select("path", F.posexplode("names").alias("place", "name"))
    first = cells.groupBy(F.lower("name").alias("key")).agg(F.min(F.struct("path", "place", "name")).alias("first"), F.max("place").alias("last"))
    rows = first.orderBy("first").collect()  # one row per different column name
    return [row["first"]["name"] for row in rows], max((row["last"] for row in rows), default=-1) + 1


@dataclass(frozen=True)
class FolderScan:
    """A folder's rows, all text, and what was noticed while reading it."""

    table: DataFrame
    findings: DataFrame


def scanned_lines(spark: SparkSession, folder: str, pattern: str, recursive: bool = False, tolerant: bool = False) -> DataFrame:
    """The files' lines as ``value`` with their input order, and whether their bytes were ``broken``.
    Bytes that are not UTF-8 become U+FFFD; byte-order marks go."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).option("ignoreCorruptFiles", tolerant)
    with _listing(spark):
        lines = order.with_order(reader.text(folder))
    broken = F.col("value").isNotNull() & ~F.is_valid_utf8("value")
    text = F.make_valid_utf8("value")
    bare = F.when(text.startswith(_MARK), F.substring(text, 2, 2**31 - 1)).otherwise(text)
    return lines.withColumn("broken", broken).withColumn("value", bare)


def damaged_lines(lines: DataFrame) -> DataFrame:
    """Findings on lines with broken bytes, one per file: how many, and the block and line of the first."""
    starts = lines.groupBy("_file", "_block_start").agg(
        F.min("_row").alias("start"), F.min(F.when(F.col("broken"), F.col("_row"))).alias("bad"), F.count_if("broken").alias("n")
    )
    by_file = starts.where("n > 0").groupBy("_file").agg(
        F.sum("n").alias("observed"), F.min(F.struct("_block_start", (F.col("bad") - F.col("start") + 1).alias("line"))).alias("first")
    )
    place = F.concat(F.lit("lines with bytes that are not UTF-8, the first in the block at byte "), "first._block_start", F.lit(", line "), "first.line")
    return by_file.select(
        F.col("_file").alias("symbol"), F.lit("broken_bytes").alias("check"), F.lit("warning").alias("severity"), "observed", place.alias("message")
    )


def parsed_lines(lines: DataFrame, found: DataFrame, columns: list[str], width: int, marks: str) -> DataFrame:
    """Every line under its own file's layout: (columns, all text, input order). Lines that equal their file's header are headers."""
    names = F.transform("names", lambda x: F.lower(x))
    places = F.array(*[F.array_position(names, F.lit(c.lower())).cast("int") for c in columns])
    small = stored(found.where("separator is not null").select(F.col("file").alias("_file"), "separator", "header", places.alias("places")), "layouts")
    body = lines.where(F.trim("value") != "").join(small, "_file").where("value != header")
    schema = ", ".join(f"`_{i}` string" for i in range(width))
    cells = F.coalesce(*[F.when(F.col("separator") == mark, F.from_csv("value", schema, {"sep": mark})) for mark in marks])
    body = body.withColumn("_cells", cells)
    body = body.withColumn("_cells", F.array(*[F.col("_cells").getField(f"_{i}") for i in range(width)]))
    picked = [F.when(F.get("places", F.lit(i)) > 0, F.get("_cells", F.get("places", F.lit(i)) - 1)).alias(c) for i, c in enumerate(columns)]
    return body.select(*picked, *order.ORDER)


def read_folder(
    spark: SparkSession,
    folder: str,
    sep: str = "auto",
    layout: fixedwidth.FixedWidthLayout | None = fixedwidth.QUOTES,
    tolerant: bool = False,
    suffix: str = ".csv",
    recursive: bool = False,
) -> FolderScan:
    """Every ``.csv`` (and, with a ``layout``, fixed-width ``.txt``) of a folder.

    Columns that a file lacks are null; of two columns of one name in a file the first counts.
    A file without a header line is skipped. Files may be broken: bytes that are not UTF-8
    are replaced and reported with their place. ``tolerant`` leaves out what cannot be read.
    """
    pattern = glob_of(suffix)
    found = stored(layouts(listed_files(spark, folder, pattern, recursive), sep), "heads")
    columns, width = columns_of(found)
    lines = scanned_lines(spark, folder, pattern, recursive, tolerant)
    scans = [parsed_lines(lines, found, columns, width, SEPARATORS if sep == "auto" else sep)] if columns else []
    if layout is not None and not listed_files(spark, folder, glob_of(".txt"), recursive).isEmpty():
        scans.append(fixedwidth.read_quotes(spark, folder, layout, glob_of(".txt"), recursive))
    if not scans:
        reason = "it holds no price file" if found.isEmpty() else "none of its files could be parsed"
        raise NoInput(f"nothing to read in {folder}: {reason}")
    table = scans[0] if len(scans) == 1 else scans[0].unionByName(scans[1], allowMissingColumns=True)
    skipped = found.where(F.col("separator").isNull()).select(
        F.col("path").alias("symbol"),
        F.lit("skipped_file").alias("check"),
        F.lit("warning").alias("severity"),
        F.lit(0).cast("bigint").alias("observed"),
        F.lit("file without a header was skipped").alias("message"),
    )
    findings = quality.separator_findings(found.select("path", "separator")).unionByName(skipped)
    return FolderScan(table, findings.unionByName(damaged_lines(lines)) if columns else findings)
