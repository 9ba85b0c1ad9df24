import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tickloom.operators import backtest, charts, features, forecast, learners, ohlcv, ridge
from tickloom.operators.series import SeriesError
from tickloom.plans import forecasting


def _series(symbol, closes, start="2023-01-02", freq="D"):
    dates = pd.date_range(start, periods=len(closes), freq=freq)
    return pd.DataFrame({"ticker": symbol, "date": dates, "close": np.asarray(closes, float)})


@pytest.fixture(scope="module")
def walks():
    draw = np.random.default_rng(5)
    frames = [_series("UP", 100 + 0.5 * np.arange(80))]
    for name, size in (("W1", 260), ("W2", 91), ("W3", 25)):
        frames.append(_series(name, 50 * np.exp(np.cumsum(draw.normal(0, 0.02, size))), freq="B"))
    frames += [_series("FLAT", [7.0] * 40), _series("SHORT", [1, 2, 3, 4, 5]), _series("THIN", np.arange(1, 16))]
    return pd.concat(frames, ignore_index=True)


@pytest.fixture(scope="module")
def series(spark, walks):
    return features.model_input(spark.createDataFrame(walks)).repartition(3)


def _reference(frame, held_out=0.2):
    """The features of one series, by hand."""
    frame = frame.sort_values("date").reset_index(drop=True)
    days = (frame["date"] - frame["date"].min()).dt.days.astype(float)
    size = max(1, min(int(len(frame) * (1 - held_out)), len(frame) - 1))
    scale = max(days[:size].max(), 1.0)
    log = np.log1p(frame["close"])
    past = log.shift(1)
    made = pd.DataFrame(
        {
            "date": frame["date"], "close": frame["close"], "t": days / scale, "t2": (days / scale) ** 2, "log_t": np.log1p(days / scale),
            "lag_1": past, "lag_2": log.shift(2), "lag_3": log.shift(3), "rolling_mean_7": past.rolling(7, min_periods=2).mean(),
            "rolling_std_7": past.rolling(7, min_periods=2).std(), "momentum_5": past - log.shift(6), "log_close": log,
        }
    ).dropna().reset_index(drop=True)
    cut = max(1, min(int(len(made) * (1 - held_out)), len(made) - 1))
    return made, cut, scale, days.iloc[-1]


def test_features_match_pandas(series, walks):
    made = features.temporal_features(series).toPandas()
    for symbol in ("UP", "W1", "W2", "W3", "FLAT"):
        expected, cut, scale, _ = _reference(walks[walks["ticker"] == symbol])
        own = made[made["symbol"] == symbol].sort_values("date").reset_index(drop=True)
        assert len(own) == len(expected) and (own["part"] == "train").sum() == cut
        assert own["scale"].iloc[0] == scale
        for name in (*features.FEATURES, "log_close"):
            np.testing.assert_allclose(own[name], expected[name], atol=1e-10)


def test_headers_defaults_and_missing_values(spark):
    table = spark.createDataFrame(
        [("  ", "2024-01-01", "1.5", "2"), (None, "2024-01-02", "NaN", "3"), ("X", "bad", "1", "1")],
        "Symbol string, Data string, Fechamento string, `Máxima` string",
    )
    rows = features.model_input(table, "abc").collect()
    assert [tuple(r) for r in rows] == [("ABC", dt.date(2024, 1, 1), 1.5, 2.0, None, None)]


def test_status_reports_short_series(series):
    found = {r["symbol"]: r["status"] for r in features.series_status(series, features.temporal_features(series)).collect()}
    assert found["SHORT"] == "too_few_rows" and found["THIN"] == "too_few_feature_rows" and found["W3"] == "ok"


def test_split_keeps_a_row_on_each_side(spark):
    rows = [("A", dt.date(2024, 1, d)) for d in (1, 2)] + [("B", dt.date(2024, 1, d)) for d in range(1, 11)]
    parts = features.temporal_split(spark.createDataFrame(rows, "symbol string, date date"), 0.99)
    found = {(r["symbol"], r["part"]): r["count"] for r in parts.groupBy("symbol", "part").count().collect()}
    assert found == {("A", "train"): 1, ("A", "test"): 1, ("B", "train"): 1, ("B", "test"): 9}


def _ridge(x, y, penalty):
    """Ridge on standardised inputs with an unpenalised intercept, by direct solution."""
    n = len(y)
    spread, label = x.std(axis=0, ddof=1), y.std(ddof=1)
    beta = np.zeros(x.shape[1])
    used = spread > 1e-12
    if label > 1e-12:
        z, q = (x[:, used] - x[:, used].mean(axis=0)) / spread[used], (y - y.mean()) / label
        w = np.linalg.solve(z.T @ z / n + penalty / label * np.eye(used.sum()), z.T @ q / n)
        beta[used] = w * label / spread[used]
    return beta, y.mean() - x.mean(axis=0) @ beta


def _r2(y, p):
    total = ((y - y.mean()) ** 2).sum()
    return 1.0 - ((y - p) ** 2).sum() / total if total > 0 else float("nan")


@pytest.fixture(scope="module")
def fits(series):
    rows = features.trainable(features.temporal_features(series))
    fitted = ridge.fit_all(rows)
    return rows, fitted, {r["symbol"]: r for r in fitted.collect()}


def test_every_fit_matches_a_direct_solution(walks, fits):
    _, _, found = fits
    assert set(found) == {"UP", "W1", "W2", "W3", "FLAT"}
    for symbol in ("UP", "W1", "W2", "W3"):
        made, cut, _, _ = _reference(walks[walks["ticker"] == symbol])
        x, y = made[list(features.FEATURES)].to_numpy(), made["log_close"].to_numpy()
        fit = found[symbol]["fit"]
        objectives = []
        for i, penalty in enumerate(ridge.PENALTIES):
            beta, intercept = _ridge(x[:cut], y[:cut], penalty)
            np.testing.assert_allclose(fit["beta"][i], beta, atol=1e-7)
            assert fit["intercept"][i] == pytest.approx(intercept, abs=1e-6)
            train_r2, r2 = _r2(y[:cut], x[:cut] @ beta + intercept), _r2(y[cut:], x[cut:] @ beta + intercept)
            rmse = np.sqrt(((y[cut:] - x[cut:] @ beta - intercept) ** 2).mean())
            assert (fit["train_r2"][i], fit["r2"][i], fit["rmse"][i]) == pytest.approx((train_r2, r2, rmse), abs=1e-6)
            objectives.append(-r2 + 0.15 * max(0.0, train_r2 - r2) + 0.005 * rmse)
        assert fit["chosen"] == int(np.argmin(objectives))
        full, _ = _ridge(x, y, ridge.PENALTIES[fit["chosen"]])
        np.testing.assert_allclose(fit["full_beta"], full, atol=1e-7)


def test_fit_matches_mllib(fits):
    rows, _, found = fits
    own = rows.where((F.col("symbol") == "W1") & (F.col("part") == "train"))
    data = learners.assemble(own, features.FEATURES, "log_close")
    model = LinearRegression(maxIter=500, tol=1e-12, regParam=0.01, elasticNetParam=0.0, solver="l-bfgs").fit(data)
    np.testing.assert_allclose(found["W1"]["fit"]["beta"][1], model.coefficients.toArray(), atol=1e-5)


def test_constant_series_predicts_its_value(fits):
    fit = fits[2]["FLAT"]["fit"]
    assert np.allclose(fit["full_beta"], 0.0) and fit["full_intercept"] == pytest.approx(np.log1p(7.0))


def test_search_attempts_report_absolute_error(walks, fits):
    rows, fitted, found = fits
    table = ridge.search_attempts(rows, fitted).where("symbol = 'W2'").orderBy("reg_param").collect()
    assert [(r["reg_param"], r["epochs"]) for r in table] == [(p, None) for p in ridge.PENALTIES]
    assert sum(r["chosen"] for r in table) == 1
    made, cut, _, _ = _reference(walks[walks["ticker"] == "W2"])
    x, y = made[list(features.FEATURES)].to_numpy()[cut:], made["log_close"].to_numpy()[cut:]
    for i, row in enumerate(table):
        fit = found["W2"]["fit"]
        assert row["mae"] == pytest.approx(np.abs(y - x @ np.array(fit["beta"][i]) - fit["intercept"][i]).mean())
    assert [r["chosen"] for r in table].index(True) == found["W2"]["fit"]["chosen"]


def test_full_search_scores_every_limit_of_every_penalty(fits):
    rows, fitted, _ = fits
    made = ridge.search_grid(rows).collect()
    symbols = {r["symbol"] for r in fitted.collect()}
    assert sorted((r["symbol"], r["reg_param"], r["epochs"]) for r in made) == [
        (s, p, e) for s in sorted(symbols) for p in ridge.PENALTIES for e in ridge.ITERATION_LIMITS
    ]
    assert {r["symbol"] for r in made if r["chosen"]} == symbols and sum(r["chosen"] for r in made) == len(symbols)
    three = {(r["symbol"], r["reg_param"]): r for r in ridge.search_attempts(rows, fitted).where("symbol LIKE 'W%'").collect()}
    for r in (r for r in made if r["symbol"].startswith("W")):
        want = three[r["symbol"], r["reg_param"]]
        for name in ("train_r2", "r2", "rmse", "mae"):
            assert r[name] == pytest.approx(want[name], abs=1e-7)
        assert r["chosen"] == (want["chosen"] and r["epochs"] == 8)


def test_recursive_forecast_matches_a_loop(walks, fits):
    _, fitted, found = fits
    made = forecast.future_path(ridge.with_chosen(fitted), 40).toPandas()
    for symbol in ("UP", "W1"):
        _, _, scale, last = _reference(walks[walks["ticker"] == symbol])
        frame = walks[walks["ticker"] == symbol]
        history = list(np.log1p(frame["close"]))
        beta, intercept = np.array(found[symbol]["fit"]["full_beta"]), found[symbol]["fit"]["full_intercept"]
        expected = []
        for step in range(1, 41):
            t, recent = (last + step) / scale, history[-7:]
            x = [t, t * t, np.log1p(t), history[-1], history[-2], history[-3], np.mean(recent), np.std(recent, ddof=1), history[-1] - history[-6]]
            history.append(float(beta @ x + intercept))
            expected.append(np.expm1(history[-1]))
        own = made[made["symbol"] == symbol].sort_values("date")
        np.testing.assert_allclose(own["predicted"], expected, rtol=1e-8)
        assert own["date"].iloc[0] == (frame["date"].max() + pd.Timedelta(days=1)).date() and len(own) == 40
    with pytest.raises(ValueError):
        forecast.future_path(ridge.with_chosen(fitted), 0)


def _bisected(y, p, top=0.8):
    """Damping by bisection on the blend factor."""
    if _r2(y, p) <= top:
        return p
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if _r2(y, middle * p + (1 - middle) * y.mean()) > top else (middle, high)
    return low * p + (1 - low) * y.mean()


def test_damping_equals_bisection(spark):
    draw = np.random.default_rng(1)
    frames = []
    for name, noise in (("tight", 0.05), ("loose", 3.0), ("biased", 0.1)):
        y = draw.normal(10, 1, 50)
        frames.append(pd.DataFrame({"symbol": name, "date": pd.date_range("2024-01-01", periods=50), "close": y, "predicted": y + draw.normal(0, noise, 50) + (0.2 if name == "biased" else 0)}))
    frames.append(pd.DataFrame({"symbol": "constant", "date": pd.date_range("2024-01-01", periods=3), "close": 4.0, "predicted": [1.0, 2.0, 3.0]}))
    rows = pd.concat(frames)
    found = backtest.calibrate(spark.createDataFrame(rows), ["symbol"]).toPandas()
    for name in ("tight", "loose", "biased"):
        own = found[found["symbol"] == name].sort_values("date")
        y, p = own["close"].to_numpy(), own["predicted"].to_numpy()
        np.testing.assert_allclose(own["calibrated"], _bisected(y, p), atol=1e-9)
        assert own["calibrated_r2"].iloc[0] == pytest.approx(_r2(y, _bisected(y, p)), abs=1e-9)
        assert own["calibrated_r2"].max() <= 0.8
    constant = found[found["symbol"] == "constant"]
    assert (constant["calibrated"] == 4.0).all() and (constant["calibrated_r2"] == 1.0).all()


@pytest.mark.parametrize("size,expected", [(1, {1: 1}), (2, {1: 1, 2: 1}), (7, {1: 2, 2: 2, 3: 3}), (9, {1: 3, 2: 3, 3: 3})])
def test_fold_remainder_joins_the_last(spark, size, expected):
    rows = spark.createDataFrame([("A", dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(size)], "symbol string, date date")
    assert {r["fold"]: r["count"] for r in backtest.with_fold(rows).groupBy("fold").count().collect()} == expected


def test_forecast_of_many_series(spark, series):
    made = forecast.forecast_all(series, days=5)
    stored = spark.createDataFrame([], forecast.METRICS_SCHEMA)
    assert [(f.name, f.dataType.simpleString()) for f in stored.schema] == [(f.name, f.dataType.simpleString()) for f in made.metrics.schema]
    metrics = {r["symbol"]: r for r in made.metrics.collect()}
    assert set(metrics) == {"UP", "W1", "W2", "W3", "FLAT"}
    up = metrics["UP"]
    assert (up["train_rows"], up["test_rows"]) == (59, 15)
    assert (up["iterations"], up["epochs"]) == (3, None)
    assert up["train_target_reached"] and 0.6 <= up["train_r2"] <= 0.8
    assert up["test_r2"] == up["r2"] and len(up["backtest_folds"]) == 3 and up["backtest_summary"]["folds"] == 3
    assert metrics["FLAT"]["test_r2"] == 1.0 and metrics["FLAT"]["rmse"] == pytest.approx(0.0, abs=1e-9)
    past = made.past.toPandas()
    own = past[past["symbol"] == "W1"]
    assert metrics["W1"]["rmse"] == pytest.approx(np.sqrt(((own["close"] - own["predicted"]) ** 2).mean()))
    summary, folds = metrics["W1"]["backtest_summary"], metrics["W1"]["backtest_folds"]
    assert summary["model_rmse_mean"] == pytest.approx(np.mean([f["model_rmse"] for f in folds]))
    assert sum(f["rows"] for f in folds) == metrics["W1"]["test_rows"] == len(own)
    lines = charts.forecast_overlay(series, made.past, made.future, 5)
    assert {r["label"] for r in lines.select("label").distinct().collect()} == {"Dados reais", "Predicao passada (teste)", "Predicao futura (5 dias)"}
    assert lines.where("series = 'future'").count() == 25


def test_short_input_is_an_error(spark, walks):
    with pytest.raises(SeriesError):
        forecasting.train_predict_evaluate(spark.createDataFrame(walks[walks["ticker"] == "SHORT"]))
    with pytest.raises(ValueError):
        forecasting.train_predict_evaluate(spark.createDataFrame(walks[walks["ticker"] == "UP"]), future_days=0)


def test_full_grid_on_one_series(fits):
    rows, _, found = fits
    table, chosen = learners.search_one(rows.where("symbol = 'W2'"))
    attempts = table.collect()
    assert len(attempts) == 15 and chosen in [a.asDict() for a in attempts]
    settled = [a for a in attempts if a["epochs"] == 128]
    np.testing.assert_allclose([a["r2"] for a in settled], found["W2"]["fit"]["r2"], atol=1e-4)


def test_constant_test_label_has_no_r2(spark):
    draw = np.random.default_rng(5)
    for level in draw.uniform(1, 1e4, 5):
        days = pd.date_range("2024-01-01", periods=60).date
        close = np.where(np.arange(60) < 40, draw.uniform(1, 9, 60), level)
        series = spark.createDataFrame(pd.DataFrame({"ticker": "C", "date": days, "close": close}))
        rows = features.trainable(features.temporal_features(features.model_input(series)))
        fit = ridge.fit_all(rows).collect()[0]["fit"]
        assert all(x is None or math.isnan(x) for x in fit["r2"])


def test_model_input_dates_and_duplicates(spark):
    rows = [("a", "01/02/2024", 1.0, 1), ("a", "13/02/2024", 2.0, 2), ("a", "2024-01-02", 3.0, 3), (" ", "2024-03-01T10:00:00Z", 4.0, 4), ("a", "x", 5.0, 5)]
    table = spark.createDataFrame(rows, "ticker string, date string, close double, n int")
    found = {(r["symbol"], str(r["date"])): r["close"] for r in features.model_input(table, "zed", ["n"]).collect()}
    assert found == {("a", "2024-01-02"): 3.0, ("a", "2024-02-13"): 2.0, ("ZED", "2024-03-01"): 4.0}


def test_rank_split_is_exact_with_ties(spark):
    rows = spark.createDataFrame(
        [(f"S{i}", float(i), dt.date(2024, 1, 1 if i < 3 else 2)) for i in range(20)], "symbol string, label double, trade_date_fmt date"
    )
    first, last = learners.split_by_rank(rows, 0.25)
    a, b = first.collect(), last.collect()
    assert (len(a), len(b)) == (15, 5) and len({r["symbol"] for r in a + b}) == 20
    assert max(r["trade_date_fmt"] for r in a) <= min(r["trade_date_fmt"] for r in b)
    parts = [p.collect() for p in learners.split_by_rank(rows, (0.25, 0.2))]
    assert [len(p) for p in parts] == [12, 3, 5] and sorted(parts[0] + parts[1]) == sorted(a) and sorted(parts[2]) == sorted(b)
    with pytest.raises(SeriesError):
        learners.split_by_rank(rows.limit(1))
    with pytest.raises(SeriesError):
        learners.split_by_rank(rows.limit(2), (0.5, 0.5))


def test_daily_rows_equal_the_split_scan(spark, walks):
    bars = spark.createDataFrame(walks[["ticker", "date", "close"]]).selectExpr(
        "ticker as symbol", "date_format(date, 'yyyy-MM-dd') as trade_date", "close as open", "close as high", "close as low", "close", "1 as volume"
    )
    plain = learners.next_close_rows(ohlcv.daily_training_rows(bars))
    split = learners.next_close_rows(ohlcv.training_rows(bars, ["trade_date"], F.lit(0)))
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty() and plain.count() > 400


def test_learners_keep_bounded_partitions(spark):
    rows = spark.range(0, 1000, 1, 2)
    with learners._packed(rows, 100) as kept:
        sizes = [len(part) for part in kept.rdd.glom().collect()]
        assert len(sizes) >= 10 and sum(sizes) == 1000 and max(sizes) <= 200
    with learners._packed(rows) as kept:
        assert kept.rdd.getNumPartitions() == 2
