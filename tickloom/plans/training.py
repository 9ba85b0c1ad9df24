"""Next-close model comparison on a folder of OHLCV files, scored on a held-out file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators import learners, ohlcv, tickers
from tickloom.plans.session import materialised
from tickloom.sources import delimited, fixedwidth, order, sinks


@dataclass(frozen=True)
class TrainingResult:
    symbol: str
    best: str
    train_rows: int
    validation_rows: int
    comparison: DataFrame
    test: DataFrame


def load_file(spark: SparkSession, path: str, sep: str = "auto") -> DataFrame:
    """One OHLCV file, delimited or fixed width by its suffix."""
    if path.lower().endswith(".txt"):
        return fixedwidth.read_quotes(spark, path)
    return delimited.read_file(spark, path, sep)


def _training_rows(table: DataFrame) -> DataFrame:
    return ohlcv.training_rows(ohlcv.fill_training_types(table), order.ORDER, order.block())


def run_training(
    spark: SparkSession, training_folder: str, test_path: str, output_root: str, sep: str = "auto",
    symbol: str | None = None,
) -> TrainingResult:
    """Compare the learners on one symbol (the one with most rows unless given), write the
    comparison and the test score as CSV."""
    rows = _training_rows(delimited.read_folder(spark, training_folder, sep).table)
    if symbol is None:
        symbol = tickers.top_symbols(rows, 1).collect()[0]["symbol"]
    data = materialised(learners.next_close_rows(rows, symbol))
    train, validation = learners.split_by_rank(data)
    best, model, comparison = learners.compare(train, validation)
    held_out = learners.next_close_rows(_training_rows(load_file(spark, test_path, sep)), symbol)
    test = learners.held_out_score(model, held_out)
    sinks.write_csv(comparison, f"{output_root}/training_results.csv")
    sinks.write_csv(test, f"{output_root}/test_results.csv")
    return TrainingResult(symbol, best, train.count(), validation.count(), comparison, test)
