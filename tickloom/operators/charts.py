"""Frames a chart can draw directly; drawing itself is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numbers import millions
from tickloom.operators import profile, series, tickers

# Legend texts of the forecast chart.
ACTUAL_LABEL = "Dados reais"
PAST_LABEL = "Predicao passada (teste)"
FUTURE_LABEL = "Predicao futura ({days} dias)"


def trend(table: DataFrame, measure: str, n: int = tickers.TOP_SYMBOLS, day: str = "date") -> DataFrame:
    """Mean of ``measure`` per day for the ``n`` symbols with most rows."""
    return tickers.only_top_symbols(table, n).groupBy("symbol", day).agg(F.avg(measure).alias(measure))


def symbol_frame(table: DataFrame, symbol: str, day: str = "date", check: bool = True) -> DataFrame:
    """One symbol's prices with volume in millions, by day; undated rows are left out.
    ``check`` makes a symbol without rows an error."""
    own = table.where(F.col("symbol") == symbol)
    if check and own.isEmpty():
        raise series.SeriesError(f"no rows for symbol {symbol}")
    return (
        own.where(F.col(day).isNotNull())
        .select(day, "open", "high", "low", "close", millions(F.col("volume")).alias("volume_millions"))
        .orderBy(day)
    )


def correlation_chart(table: DataFrame, columns: Sequence[str] = profile.CORRELATED) -> DataFrame:
    """Correlations with two decimals, as written on a heat map; no label where there is none."""
    matrix = profile.correlation_matrix(table, columns)
    return matrix.withColumn("label", F.when(F.col("correlation").isNotNull(), F.format_string("%.2f", "correlation")))


def forecast_overlay(actual: DataFrame, past: DataFrame, future: DataFrame, horizon_days: int) -> DataFrame:
    """Actual, past and future lines of every symbol: (symbol, series, label, date, value)."""

    def line(frame: DataFrame, name: str, label: str, value: str) -> DataFrame:
        return frame.select(
            "symbol", F.lit(name).alias("series"), F.lit(label).alias("label"), "date", F.col(value).alias("value")
        )

    future_label = FUTURE_LABEL.format(days=max(1, int(horizon_days)))
    return (
        line(actual, "actual", ACTUAL_LABEL, "close")
        .unionByName(line(past, "past", PAST_LABEL, "predicted"))
        .unionByName(line(future, "future", future_label, "predicted"))
    )
