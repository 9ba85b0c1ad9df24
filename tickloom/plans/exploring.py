"""Exploration of a curated table: profile, symbol counts, trends and correlations as CSV."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tickloom.operators import charts, profile, tickers
from tickloom.sources import curated, sinks


def explore(spark: SparkSession, curated_path: str, output_root: str, top: int = tickers.TOP_SYMBOLS) -> dict[str, str]:
    table = curated.read_curated(spark, curated_path)
    frames = {
        "data_summary": profile.profile(table),
        "symbol_counts": tickers.symbol_counts(table),
        "stock_price_trends": charts.trend(table, "close", top, "trade_date_fmt"),
        "volume_trends": charts.trend(table, "volume", top, "trade_date_fmt"),
        "correlations": charts.correlation_chart(table),
    }
    return {name: sinks.write_csv(frame, f"{output_root}/{name}.csv") for name, frame in frames.items()}
