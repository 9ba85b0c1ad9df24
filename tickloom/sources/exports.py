"""Artifacts of forecast runs read back from their folder, and as one nested record per run.

Metrics keep their nested folds and summary, nulls among them, since their files hold every
field. A record gathers what belongs to one run: its metrics and its predictions, which are at
most one a calendar day. As text a record is one line of JSON, and reading that text gives
the record again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import forecast
from tickloom.sources.sinks import EXPORT_NAMES, TEST_METRICS

KEY = "run_key string"
SCHEMAS = {
    "training_metrics": f"{forecast.METRICS_SCHEMA}, {KEY}",
    "training_search": f"symbol string, epochs int, reg_param double, train_r2 double, r2 double, rmse double, mae double, chosen boolean, {KEY}",
    "test_predictions": f"symbol string, date date, close double, predicted double, {KEY}",
    "future_predictions": f"symbol string, date date, predicted double, {KEY}",
}
_PAST = "array<struct<date:date,close:double,predicted:double>>"
_FUTURE = "array<struct<date:date,predicted:double>>"
_SEARCH = "array<struct<reg_param:double,epochs:int,train_r2:double,r2:double,rmse:double,mae:double,chosen:boolean>>"
_METRICS = "struct<" + ",".join(x.strip().replace(" ", ":", 1) for x in forecast.METRICS_SCHEMA.split(", ")) + ">"
RECORD = f"run_key string, symbol string, metrics {_METRICS}, search {_SEARCH}, past {_PAST}, future {_FUTURE}"
_JSON = {"ignoreNullFields": "false"}


@dataclass(frozen=True)
class Exports:
    """The artifact tables of all runs below one folder."""

    metrics: DataFrame
    search: DataFrame
    past: DataFrame
    future: DataFrame
    train: DataFrame
    test: DataFrame


def read_artifact(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One artifact table under its known schema; columns of CSV files are matched by their headers."""
    path, schema = f"{root.rstrip('/')}/{name}", SCHEMAS[name]
    if name == "training_metrics":
        return spark.read.schema(schema).json(path)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_exports(spark: SparkSession, root: str) -> Exports:
    own_names = {header: name for name, header in EXPORT_NAMES.items()}

    def rows(part: str) -> DataFrame:
        table = spark.read.parquet(f"{root.rstrip('/')}/{part}_parquet")
        return table.select(*[F.col(c).alias(own_names.get(c, c)) for c in table.columns])

    read = [read_artifact(spark, root, name) for name in ("training_metrics", "training_search", "test_predictions", "future_predictions")]
    return Exports(*read, rows("train"), rows("test"))


def test_metrics(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, run_key, keys, the kept metrics): ``keys`` are the record's keys in the order in which its text has them."""
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], forecast.METRICS_SCHEMA).schema}
    schema = ", ".join(f"{name} {kinds[name]}" for name in TEST_METRICS)
    lines = spark.read.text(f"{root.rstrip('/')}/test_metrics")
    parsed = F.from_json("value", f"symbol string, {KEY}, {schema}")
    return lines.select(F.array_join(F.json_object_keys("value"), ",").alias("keys"), parsed.alias("m")).select("keys", "m.*")


test_metrics.__test__ = False  # not a test


def _gathered(table: DataFrame, names: Sequence[str], name: str) -> DataFrame:
    """(run_key, rows of the run as a sorted array of structs)."""
    return table.groupBy("run_key").agg(F.sort_array(F.collect_list(F.struct(*names))).alias(name))


def records(exports: Exports) -> DataFrame:
    """One nested record per run. Runs without predictions have empty arrays, runs without metrics are left out."""
    metrics = exports.metrics
    nested = metrics.select("run_key", "symbol", F.struct(*[c for c in metrics.columns if c != "run_key"]).alias("metrics"))
    parts = {
        "search": _gathered(exports.search, ["reg_param", "epochs", "train_r2", "r2", "rmse", "mae", "chosen"], "search"),
        "past": _gathered(exports.past, ["date", "close", "predicted"], "past"),
        "future": _gathered(exports.future, ["date", "predicted"], "future"),
    }
    for name, part in parts.items():
        nested = nested.join(part, "run_key", "left").withColumn(name, F.coalesce(name, F.array()))
    return nested


def as_text(frame: DataFrame) -> DataFrame:
    """Records as (run_key, value): one line of JSON each, null fields included."""
    return frame.select("run_key", F.to_json(F.struct(*frame.columns), _JSON).alias("value"))


def from_text(value: Column) -> Column:
    return F.from_json(value, RECORD)
