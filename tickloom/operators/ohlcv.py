"""Open/high/low/close/volume tables: typed curation and next-close training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import dates, names, numbers
from tickloom.operators.neighbours import with_neighbours

# The raw table's columns, all text.
RAW_COLUMNS = ("symbol", "trade_date", "open", "high", "low", "close", "volume")
PRICES = ("open", "high", "low", "close")
UNKNOWN_SYMBOL = "UNKNOWN"


def as_raw_text(table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The seven raw columns as text; other columns are dropped, a missing one is an error."""
    absent = [name for name in RAW_COLUMNS if name not in table.columns]
    if absent:
        raise names.MissingColumn(f"required columns not found: {', '.join(absent)}")
    return table.select(*[F.col(name).cast("string").alias(name) for name in RAW_COLUMNS], *keep)


def curate(raw: DataFrame, order: Sequence[str], block: Column) -> DataFrame:
    """Typed table with the previous known close and the daily percent change.

    ``order`` and ``block`` describe the input order (see ``sources.order``), which
    settles rows that share symbol and date.
    """
    typed = as_raw_text(raw, order).withColumns(
        {
            "symbol": F.coalesce("symbol", F.lit(UNKNOWN_SYMBOL)),
            "trade_date": F.coalesce("trade_date", F.lit(dates.EPOCH_DAY)),
            **{name: numbers.to_double(F.col(name)) for name in PRICES},
            "volume": numbers.to_long(F.col("volume")),
        }
    )
    dated = typed.withColumn("_day", dates.ohlcv_date(F.col("trade_date")))
    linked = with_neighbours(dated, "symbol", "_day", order, block, "close", last_known="prev_close")
    changed = linked.withColumns(
        {
            "trade_date_fmt": dates.iso_text(F.col("_day")),
            "daily_pct_change": numbers.percent_change(F.col("close"), F.col("prev_close")),
        }
    )
    return changed.fillna(
        {**{name: 0.0 for name in PRICES}, "volume": 0, "daily_pct_change": 0.0}
    ).select(*RAW_COLUMNS, "trade_date_fmt", "prev_close", "daily_pct_change")


def _training_types(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "trade_date_fmt": dates.training_date(F.col("trade_date").cast("string")),
            **{name: numbers.to_double(F.col(name)) for name in (*PRICES, "volume")},
        }
    )


def training_rows(raw: DataFrame, order: Sequence[str], block: Column) -> DataFrame:
    """Rows that have a next close, with the previous and next close of their symbol."""
    linked = with_neighbours(
        _training_types(raw), "symbol", "trade_date_fmt", order, block, "close",
        previous="prev_close", following="next_close",
    )
    return linked.where(F.col("next_close").isNotNull())


def daily_training_rows(bars: DataFrame) -> DataFrame:
    """The same for tables of one row per symbol and day: a symbol has a row per calendar day
    at most, so a plain window will do."""
    by_day = Window.partitionBy("symbol").orderBy(F.col("trade_date_fmt").asc_nulls_first())
    linked = _training_types(bars).withColumns(
        {"prev_close": F.lag("close").over(by_day), "next_close": F.lead("close").over(by_day)}
    )
    return linked.where(F.col("next_close").isNotNull())


def fill_training_types(raw: DataFrame) -> DataFrame:
    """Add the optional price columns a training file may lack, as null text."""
    return raw.withColumns(
        {name: F.lit(None).cast("string") for name in RAW_COLUMNS if name not in raw.columns}
    )
