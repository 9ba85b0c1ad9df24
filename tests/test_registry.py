import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import features, registry
from tickloom.plans import forecasting
from tickloom.sources import exports, sinks, versions

START = dt.datetime(2024, 1, 1)


def _runs(spark, rows):
    made = [(key, symbol, action, number, START + dt.timedelta(minutes=i), "src") for i, (key, symbol, action, number) in enumerate(rows)]
    return spark.createDataFrame(made, registry.RUN_SCHEMA)


def test_the_latest_seven_runs_are_kept(spark):
    runs = _runs(spark, [(f"cache-{i}", "A", None, i) for i in range(10)] + [("other", "B", None, 1)]).repartition(3)
    kept = registry.retained_runs(runs)
    assert {r["run_key"] for r in kept.collect()} == {f"cache-{i}" for i in range(3, 10)} | {"other"}


def test_registering_a_key_again_replaces_it(spark):
    runs = _runs(spark, [(f"k{i}", "A", "act", i) for i in range(7)] + [("k0", "A", "act", 0), ("k7", "A", "act", 7)])
    assert {r["run_key"] for r in registry.retained_runs(runs).collect()} == {"k0", "k2", "k3", "k4", "k5", "k6", "k7"}


def test_only_the_newest_rows_of_a_group_are_shuffled(spark):
    runs = _runs(spark, [(f"k{i}", "A", None, i) for i in range(20)])
    plan = registry.latest_runs(runs)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_attempts_are_counted_and_capped(spark):
    rows = spark.createDataFrame([("A", START)] * 9 + [("B", START)], "symbol string, updated_at timestamp")
    found = {r["symbol"]: (r["total"], r["effective"], r["limit_reached"]) for r in registry.attempt_counts(rows).collect()}
    assert found == {"A": (9, 7, True), "B": (1, 1, False)}


def test_valid_runs_need_every_artifact(spark):
    runs = _runs(spark, [("k1", "A", "a", 1), ("k2", "A", "a", 2)])
    both = spark.createDataFrame([("k1",), ("k2",), ("k1",)], "run_key string")
    artifacts = {"training_metrics": both, "test_predictions": both.where("run_key = 'k1'"), "future_predictions": both}
    assert [r["run_key"] for r in registry.valid_runs(runs, artifacts).collect()] == ["k1"]
    with pytest.raises(ValueError):
        registry.valid_runs(runs, {"training_metrics": both})


def test_reuse_by_ticker_or_by_fingerprint(spark):
    valid = _runs(spark, [(f"k{i}", "A", "old", i + 1) for i in range(7)] + [("b1", "B", "act-b", 4)])
    wanted = spark.createDataFrame([("A", "new"), ("B", "act-b"), ("C", "act-c")], "symbol string, action_key string")
    found = {r["symbol"]: (r["decision"], r["run_key"]) for r in registry.reuse_plan(wanted, valid).collect()}
    assert found == {"A": ("reuse", "k6"), "B": ("train", "act-b::run-5"), "C": ("train", "act-c::run-1")}
    strict = {r["symbol"]: r["decision"] for r in registry.reuse_plan(wanted, valid, "fingerprint").collect()}
    assert strict["A"] == "train"


def _series(spark, change=None):
    draw = np.random.default_rng(4)
    frame = pd.concat(
        pd.DataFrame({"ticker": s, "date": pd.date_range("2024-01-01", periods=40), "close": 20 + draw.normal(0, 1, 40).cumsum() * 0.1})
        for s in ("A", "B")
    )
    if change:
        frame.loc[(frame["ticker"] == "A") & (frame["date"] == "2024-01-05"), "close"] += change
    return features.model_input(spark.createDataFrame(frame))


def test_fingerprint_changes_exactly_with_the_input(spark):
    def keys(table, **options):
        made = registry.fingerprints(table, **{"source_name": "x", "held_out": 0.2, "days": 31, **options})
        return {r["symbol"]: r["action_key"] for r in made.collect()}

    base = keys(_series(spark))
    assert keys(_series(spark).repartition(3)) == base
    assert keys(_series(spark), source_name=" X ") == base
    moved = keys(_series(spark, 1e-6))
    assert moved["A"] != base["A"] and moved["B"] == base["B"]
    assert keys(_series(spark, 1e-11)) == base
    for other in ({"days": 30}, {"held_out": 0.3}, {"source_name": "y"}):
        assert not set(keys(_series(spark), **other).values()) & set(base.values())


def test_a_request_beyond_the_limit_reuses_the_latest_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "MAX_RUNS", 2)
    table, root = _series(spark), str(tmp_path)
    latest = None
    for i in range(3):
        run = forecasting.run_forecast(spark, table, root, "demo", days=3, now=START + dt.timedelta(minutes=i))
        plan = {r["symbol"]: r for r in run.plan.collect()}
        if i != 1:
            metrics = {r["symbol"]: r for r in run.metrics.collect()}
            assert set(metrics) == {"A", "B"}
            assert metrics["A"]["from_cache"] == (i == 2) and metrics["A"]["ticker_processing_count_total"] == i + 1
            assert metrics["A"]["cache_limit_reached"] == (i == 2) and metrics["A"]["ticker_reprocess_count"] == min(i + 1, 2)
            assert run.future.count() == 6
            assert len(metrics["A"]["backtest_folds"]) == 3
        if i < 2:
            assert plan["A"]["decision"] == "train" and plan["A"]["run_number"] == i + 1
            latest = plan["A"]["run_key"]
    assert plan["A"]["decision"] == "reuse" and plan["A"]["run_key"] == latest
    assert forecasting.registered_runs(spark, root).count() == 4
    exported = spark.read.parquet(f"{root}/artifacts/train_parquet")
    assert exported.columns == ["ticker", "data", "fechamento", "mínima", "máxima", "volume", "run_key"]


def test_forecast_from_a_treated_file(spark, tmp_path):
    path = tmp_path / "treated.csv"
    path.write_text("Date;Close\n" + "".join(f"{d.date()};{10 + i % 5}\n" for i, d in enumerate(pd.date_range("2024-01-01", periods=40))))
    run = forecasting.run_forecast_from_csv(spark, str(path), str(tmp_path / "reg"), "petr4", days=2)
    assert [r["symbol"] for r in run.metrics.collect()] == ["PETR4"]
    assert run.future.count() == 2
    assert run.past.where(F.col("close").isNull()).count() == 0


def test_exports_come_back_as_nested_records(spark, tmp_path):
    run = forecasting.run_forecast(spark, _series(spark), str(tmp_path), "demo", days=3, now=START)
    whole = exports.read_exports(spark, str(tmp_path / "artifacts"))
    assert whole.train.columns == ["symbol", "date", "close", "low", "high", "volume", "run_key"]
    text = exports.as_text(exports.records(whole))
    back = {r["r"]["symbol"]: r["r"] for r in text.select(exports.from_text(F.col("value")).alias("r")).collect()}
    metrics = {r["symbol"]: r for r in run.metrics.collect()}
    assert set(back) == {"A", "B"}
    for symbol, record in back.items():
        assert record["metrics"]["backtest_folds"] == metrics[symbol]["backtest_folds"] and record["metrics"]["epochs"] is None
        assert len(record["future"]) == 3 and [f["date"] for f in record["future"]] == sorted(f["date"] for f in record["future"])
        assert len(record["past"]) == metrics[symbol]["test_rows"] and sum(a["chosen"] for a in record["search"]) == 1
    assert all('"epochs":null' in r["value"] for r in text.collect())
    kept = exports.test_metrics(spark, str(tmp_path / "artifacts")).collect()
    assert {tuple(r["keys"].split(",")) for r in kept} == {("symbol", "run_key", *sinks.TEST_METRICS)} and len(sinks.TEST_METRICS) == 11
    assert {r["symbol"]: r["rmse"] for r in kept} == {s: m["rmse"] for s, m in metrics.items()}


VERSIONED = ("k string, at int, v string", "k", ["at"])


def _table(spark, root):
    return {r["k"]: (r["at"], r["v"]) for r in versions.read(spark, root, *VERSIONED).collect()}


def _append(spark, root, *rows):
    return versions.append(spark.createDataFrame(rows, VERSIONED[0]), root)


def test_last_writer_wins_before_and_after_compaction(spark, tmp_path):
    root = str(tmp_path)
    assert _table(spark, root) == {}
    _append(spark, root, ("a", 2, "x"), ("b", 1, "x"))
    _append(spark, root, ("a", 1, "late"), ("c", 1, None))
    wanted = {"a": (2, "x"), "b": (1, "x"), "c": (1, None)}
    assert _table(spark, root) == wanted and versions.compact(spark, root, *VERSIONED)
    assert _table(spark, root) == wanted
    _append(spark, root, ("b", 1, "y"), ("b", 0, "z"))
    assert _table(spark, root) == {**wanted, "b": (1, "y")}
    assert versions.compact(spark, root, *VERSIONED) and versions.compact(spark, root, *VERSIONED)
    assert len(versions.vacuum(spark, root)) == 3 + 2 * 2
    assert _table(spark, root) == {**wanted, "b": (1, "y")}
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("manifest")] == ["manifest-000000003"]


def test_a_writer_that_stops_half_way_is_never_seen(spark, tmp_path):
    root = str(tmp_path)
    _append(spark, root, ("a", 1, "x"))
    half = _append(spark, root, ("a", 9, "half"))
    (tmp_path / "log" / half / "_SUCCESS").unlink()
    (tmp_path / "data" / "stopped").mkdir(parents=True)
    (tmp_path / ".draft-stopped").write_text("{")
    assert _table(spark, root) == {"a": (1, "x")}
    assert versions.compact(spark, root, *VERSIONED) and _table(spark, root) == {"a": (1, "x")}


def test_two_jobs_register_at_once_and_nothing_is_lost(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _append(spark, root, ("a", 1, "x"))
    plain, done = versions.last_written, []

    def other_job_first(rows, key, order):
        if not done:  # while this compaction writes, another job registers and compacts
            done.append(True)
            _append(spark, root, ("b", 1, "y"))
            assert versions.compact(spark, root, *VERSIONED)
        return plain(rows, key, order)

    monkeypatch.setattr(versions, "last_written", other_job_first)
    assert not versions.compact(spark, root, *VERSIONED)
    monkeypatch.undo()
    assert _table(spark, root) == {"a": (1, "x"), "b": (1, "y")}
    assert len(list((tmp_path / "data").iterdir())) == 1 and not list(tmp_path.glob(".draft*"))


def test_run_keys_of_exports_are_made_once(spark, tmp_path):
    made_keys = spark.sparkContext.accumulator(0)

    def key(symbol):
        made_keys.add(1)
        return f"run-{symbol}"

    made = forecasting.forecast.forecast_all(_series(spark), days=3, keep=lambda frame: frame.localCheckpoint())
    keys = made.metrics.select("symbol", F.udf(key, "string")("symbol").alias("run_key"))
    sinks.write_forecast(made, keys, str(tmp_path / "out"))
    assert made_keys.value == made.metrics.count() == spark.read.text(str(tmp_path / "out" / "test_metrics")).count()
