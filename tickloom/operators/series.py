"""Arbitrary price tables to treated series: one (symbol, date, close) row per day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import dates, names, numbers
from tickloom.operators.ohlcv import UNKNOWN_SYMBOL
from tickloom.operators.ordering import position

# History kept and the size under which metrics are called unstable.
MAX_PERIOD_DAYS = 365
MIN_RECOMMENDED_ROWS = 30

MODES = {
    "strict": (dates.strict_date, numbers.strict_decimal),
    "lenient": (dates.lenient_date, numbers.lenient_decimal),
}


class SeriesError(ValueError):
    """The input holds no usable series."""


@dataclass(frozen=True)
class Layout:
    """Header names of the logical columns of one price table."""

    date: str
    close: str
    symbol: str | None

    @classmethod
    def of(
        cls,
        table: DataFrame,
        date_names: Sequence[str] = names.DATE_NAMES,
        close_names: Sequence[str] = names.CLOSE_NAMES,
        symbol_names: Sequence[str] = names.SYMBOL_NAMES,
        exact_first: bool = False,
    ) -> Layout:
        columns = table.columns
        return cls(
            names.find_column(columns, date_names, "Date", exact_first=exact_first),
            names.find_column(columns, close_names, "Close", exact_first=exact_first),
            names.find_column(columns, symbol_names, "symbol", required=False, exact_first=exact_first),
        )


def quoted(name: str) -> Column:
    """Column by header name; headers may hold dots and blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_symbol(text: Column) -> Column:
    return F.coalesce(F.nullif(dates.stripped(text), F.lit("")), F.lit(UNKNOWN_SYMBOL))


def parse_series(
    table: DataFrame, order: Sequence[str], mode: str = "strict", layout: Layout | None = None
) -> DataFrame:
    """(symbol, date, close, *order) with null where text cannot be read; no row is dropped."""
    layout = layout or Layout.of(table, exact_first=mode == "lenient")
    parse_date, parse_close = MODES[mode]
    symbol = F.lit(UNKNOWN_SYMBOL) if layout.symbol is None else clean_symbol(quoted(layout.symbol).cast("string"))
    return table.select(
        symbol.alias("symbol"),
        parse_date(quoted(layout.date).cast("string")).alias("date"),
        parse_close(quoted(layout.close).cast("string")).alias("close"),
        *order,
    )


def keep_last_per_day(parsed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Valid rows only, one per (symbol, date): the last in input order. Duplicates
    collapse before the shuffle, so a hot symbol arrives as at most one row per day.

    Invalid rows take part without a position and their groups are dropped afterwards: a
    filter in front would make the optimizer parse every text twice.
    """
    valid = F.col("date").isNotNull() & F.col("close").isNotNull()
    return (
        parsed.groupBy("symbol", "date")
        .agg(F.max_by("close", F.when(valid, position(order))).alias("close"))
        .where(F.col("close").isNotNull())
    )


def valid_day() -> Column:
    """The day of a parsed row, null where date or close can't be used."""
    return F.when(F.col("date").isNotNull() & F.col("close").isNotNull(), F.col("date"))


def days(parsed: DataFrame, order: Sequence[str]) -> DataFrame:
    """(symbol, day, rows, close): per symbol and day its rows and its last close. Rows that can't be used have no day.

    Treated rows and findings both follow from it, so that a source is read once for the two.
    """
    day = valid_day()
    last = F.max_by("close", F.when(day.isNotNull(), position(order)))
    return parsed.groupBy("symbol", day.alias("day")).agg(F.count(F.lit(1)).alias("rows"), last.alias("close"))


def daily_closes(counted: DataFrame) -> DataFrame:
    """The rows of ``keep_last_per_day`` from those of ``days``."""
    return counted.where(F.col("day").isNotNull()).select("symbol", F.col("day").alias("date"), "close")


def mark_trim(daily: DataFrame, max_period_days: int = MAX_PERIOD_DAYS) -> DataFrame:
    """Add each symbol's newest day and whether the row lies inside the look-back."""
    newest = F.max("date").over(Window.partitionBy("symbol"))
    return daily.withColumn("newest", newest).withColumn(
        "recent", F.col("date") >= F.date_sub(F.col("newest"), max_period_days)
    )


def treat(
    table: DataFrame,
    order: Sequence[str],
    mode: str = "strict",
    max_period_days: int = MAX_PERIOD_DAYS,
    layout: Layout | None = None,
) -> DataFrame:
    """The treated series of every symbol in the table: (symbol, date, close)."""
    daily = keep_last_per_day(parse_series(table, order, mode, layout), order)
    return mark_trim(daily, max_period_days).where("recent").select("symbol", "date", "close")


def between(prices: DataFrame, tickers: Sequence[str], start, end) -> DataFrame:
    """Rows of the tickers from ``start`` to ``end``, both days included.

    Tickers are trimmed and upper-cased. The predicates are plain comparisons on
    columns, so they reach the scan and prune partitions and row groups.
    """
    wanted, first, last = history_bounds(tickers, start, end)
    day = F.col("date")
    return prices.where(
        F.col("symbol").isin(wanted) & (day >= F.lit(first).cast("date")) & (day <= F.lit(last).cast("date"))
    )


def history_bounds(tickers: Sequence[str], start, end) -> tuple[list[str], str, str]:
    """Clean tickers, and the first and last day as ISO text."""
    wanted = sorted({ticker.strip().upper() for ticker in tickers})
    if not wanted or "" in wanted:
        raise SeriesError("give at least one ticker, none of them blank")
    first, last = _day_argument(start), _day_argument(end)
    if first > last:
        raise SeriesError("the start date must not be after the end date")
    return wanted, first, last


def _day_argument(value) -> str:
    import pandas as pd

    parsed = pd.to_datetime(value, errors="coerce")
    if pd.isna(parsed):
        raise SeriesError("start and end must be valid dates")
    return parsed.strftime("%Y-%m-%d")
