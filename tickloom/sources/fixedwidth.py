"""Fixed-width daily quote files (latin-1 text, one record per line)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import dates, numbers
from tickloom.operators import ohlcv
from tickloom.sources import order


@dataclass(frozen=True)
class FixedWidthLayout:
    """Record type, shortest usable line, and (start, end) of each field from zero."""

    record: str
    length: int
    fields: dict[str, tuple[int, int]] = field(hash=False)


# The quote record.
QUOTES = FixedWidthLayout(
    record="01",
    length=147,
    fields={
        "trade_date": (2, 10),
        "symbol": (10, 24),
        "open": (56, 69),
        "high": (69, 82),
        "low": (82, 95),
        "close": (121, 134),
        "volume": (134, 147),
    },
)


def latin1(text: Column) -> Column:
    """The text source decodes as UTF-8; this restores the characters and their positions."""
    return F.decode(text.cast("binary"), "ISO-8859-1")


def parse_quotes(lines: DataFrame, text: str = "value", layout: FixedWidthLayout = QUOTES) -> DataFrame:
    """The seven raw OHLCV text columns of the quote records; other lines are left out.
    A number or date that cannot be read is null. Other columns are carried along."""
    line = F.col(text)
    cut = {name: F.substring(line, start + 1, end - start) for name, (start, end) in layout.fields.items()}
    quotes = lines.where(line.startswith(layout.record) & (F.length(line) >= layout.length))
    carried = [name for name in lines.columns if name != text]
    parsed = {
        "symbol": F.trim(cut["symbol"]),
        "trade_date": dates.iso_text(dates.compact_date(cut["trade_date"])),
        **{name: numbers.implied_hundredths(cut[name]).cast("string") for name in ohlcv.PRICES},
        "volume": numbers.whole_or_zero(cut["volume"]).cast("string"),
    }
    return quotes.select(*[parsed[name].alias(name) for name in ohlcv.RAW_COLUMNS], *carried)


def unreadable(quotes: DataFrame) -> DataFrame:
    """Findings: how many records per symbol hold a field that could not be read."""
    bad = F.greatest(*[F.col(name).isNull().cast("int") for name in ohlcv.RAW_COLUMNS])
    counts = quotes.where(bad == 1).groupBy("symbol").agg(F.count(F.lit(1)).alias("observed"))
    return counts.select(
        F.coalesce("symbol", F.lit(ohlcv.UNKNOWN_SYMBOL)).alias("symbol"),
        F.lit("unreadable_field").alias("check"),
        F.lit("warning").alias("severity"),
        "observed",
        F.lit("records with a field that could not be read").alias("message"),
    )


def read_quotes(
    spark: SparkSession, paths: str | Sequence[str], layout: FixedWidthLayout = QUOTES, pattern: str = "*", recursive: bool = False
) -> DataFrame:
    """Quote records of files, or of a folder's files whose names fit the pattern."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    lines = order.with_order(reader.text(paths if isinstance(paths, str) else list(paths)))
    return parse_quotes(lines.withColumn("value", latin1(F.col("value"))), "value", layout)
