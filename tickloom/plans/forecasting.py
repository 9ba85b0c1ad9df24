"""Forecast many series, with the run registry deciding what is trained and what is reused."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import features, forecast, registry
from tickloom.operators.series import SeriesError
from tickloom.plans.session import materialised
from tickloom.sources import delimited, exports, order, sinks, versions

_TABLES = ("training_metrics", "test_predictions", "future_predictions")


def train_predict_evaluate(
    table: DataFrame, future_days: int = forecast.HORIZON_DAYS, test_fraction: float = features.TEST_FRACTION,
    source_name: str = "forecast",
) -> forecast.Forecast:
    """Forecast a table that holds one series of interest: its most frequent ticker. A
    series below the row minimums is an error here; ``forecast.forecast_all`` reports it."""
    series = features.model_input(table, source_name)
    sizes = series.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "symbol").limit(1).collect()
    if not sizes:
        raise SeriesError("no valid row for ticker, date and close")
    made = forecast.forecast_all(series.where(F.col("symbol") == sizes[0]["symbol"]), future_days, test_fraction)
    status = made.status.collect()[0]
    if status["status"] != "ok":
        raise SeriesError(f"series too short to train: {status['rows']} rows, {status['feature_rows']} with features")
    return made


@dataclass(frozen=True)
class ForecastRun:
    """Results of one request: new and reused runs side by side. ``status`` says which of the
    series to train were long enough; the others have a plan but no results."""

    plan: DataFrame
    metrics: DataFrame
    past: DataFrame
    future: DataFrame
    status: DataFrame


def run_forecast(
    spark: SparkSession,
    series: DataFrame,
    root: str,
    source_name: str,
    days: int = forecast.HORIZON_DAYS,
    held_out: float = features.TEST_FRACTION,
    reuse: str = "ticker",
    now: dt.datetime | None = None,
) -> ForecastRun:
    """Forecast every series of ``features.model_input`` shape under the registry at ``root``.

    The request is recorded, tickers with a full set of valid runs get their latest run
    back, and the others are trained, written and registered. Everything the decision
    depends on is materialised before the registry changes.
    """
    now = now or dt.datetime.now().replace(microsecond=0)
    moment = F.lit(now).cast("timestamp")
    keys = materialised(registry.fingerprints(series, source_name, held_out, days))
    keys.select("symbol", "action_key", moment.alias("updated_at")).write.mode("append").parquet(f"{root}/attempts")
    runs = registered_runs(spark, root)
    if runs.isEmpty():
        valid = runs
    else:
        stored = {name: _keys_of(spark, root, name) for name in _TABLES}
        valid = registry.valid_runs(registry.retained_runs(runs), stored)
    plan = materialised(registry.reuse_plan(keys, valid, reuse))
    fresh = plan.where(F.col("decision") == "train")
    wanted = series.join(fresh.select("symbol"), "symbol", "left_semi")
    made = forecast.forecast_all(wanted, days, held_out, keep=materialised)
    status = materialised(made.status)
    usable = status.where(F.col("status") == "ok").select("symbol")
    trained = materialised(fresh.join(usable, "symbol", "left_semi"))
    sinks.write_forecast(made, trained, f"{root}/artifacts")
    made_runs = trained.select(
        "run_key", "symbol", "action_key", "run_number", moment.alias("updated_at"), F.lit(source_name).alias("source_name")
    )
    versions.append(made_runs, f"{root}/runs")
    versions.compact(spark, f"{root}/runs", registry.RUN_SCHEMA, "run_key", ["updated_at"])
    counts = registry.attempt_counts(spark.read.parquet(f"{root}/attempts"))
    return _results(spark, root, plan, counts, status)


def registered_runs(spark: SparkSession, root: str) -> DataFrame:
    """One row per run key, the last registration; empty before the first run."""
    return versions.read(spark, f"{root}/runs", registry.RUN_SCHEMA, "run_key", ["updated_at"])


def _keys_of(spark: SparkSession, root: str, name: str) -> DataFrame:
    return _artifact(spark, root, name).select("run_key")


def _artifact(spark: SparkSession, root: str, name: str) -> DataFrame:
    return exports.read_artifact(spark, f"{root}/artifacts", name)


def _results(spark: SparkSession, root: str, plan: DataFrame, counts: DataFrame, status: DataFrame) -> ForecastRun:
    """Rows of the planned runs from the artifact tables, marked as new or reused."""
    chosen = plan.select("run_key")

    def of_plan(name: str) -> DataFrame:
        return _artifact(spark, root, name).join(chosen, "run_key", "left_semi")

    metrics = registry.planned_results(plan, _artifact(spark, root, "training_metrics"), counts)
    return ForecastRun(plan, metrics, of_plan("test_predictions"), of_plan("future_predictions"), status)


def run_forecast_from_csv(
    spark: SparkSession, path: str, root: str, source_name: str, sep: str = "auto",
    days: int = forecast.HORIZON_DAYS, held_out: float = features.TEST_FRACTION, reuse: str = "ticker",
    now: dt.datetime | None = None,
) -> ForecastRun:
    """Forecast a treated CSV; header names are matched in lower case."""
    table = delimited.read_file(spark, path, sep, lower_names=True)
    return run_forecast(spark, features.model_input(table, source_name, order.ORDER), root, source_name, days, held_out, reuse, now)
