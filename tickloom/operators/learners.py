"""Next-close regression with MLlib: model comparison, held-out score, and the full
penalty-by-iterations search on one chosen series."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import features, ranks, ridge
from tickloom.operators.series import SeriesError

# Inputs of the next-close models and the sizes of the compared learners.
NEXT_CLOSE_INPUTS = ("open", "high", "low", "volume", "prev_close")
LINEAR_ITERATIONS = 50
FOREST_TREES = 20
BOOSTING_ROUNDS = 20
VALIDATION_FRACTION = 0.2
MEASURES = ("rmse", "mae", "r2")
# Fixed value: most rows that a learner keeps in one partition; a tree learner holds some 220 bytes of each.
PACKED_ROWS = 500_000


def assemble(rows: DataFrame, inputs: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """(features, label, *keep) without the rows that miss an input or the label."""
    complete = rows.dropna(subset=[*inputs, label])
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="skip")
    return assembler.transform(complete).select("features", F.col(label).cast("double").alias("label"), *keep)


def next_close_rows(training: DataFrame, symbol: str | None = None) -> DataFrame:
    """Complete next-close rows, of one symbol when given. The filter is on the window's
    partition key, so the optimizer moves it below the window."""
    if symbol is not None:
        training = training.where(F.col("symbol") == symbol)
    wanted = ["symbol", "trade_date_fmt", *NEXT_CLOSE_INPUTS, "next_close"]
    return training.dropna(subset=[*NEXT_CLOSE_INPUTS, "next_close"]).select(*wanted)


def split_by_rank(rows: DataFrame, held_out: float | Sequence[float] = VALIDATION_FRACTION, day: str = "trade_date_fmt") -> list[DataFrame]:
    """Parts of the whole set in order of ``day``, the earliest first: for learning, then held out.

    Several fractions split what the one before left for learning: with ``(0.2, 0.1)`` the
    parts are for learning, the last tenth of the first four fifths, and the last fifth. The
    rows are ranked once, rows of one day by all their columns.
    """
    placed = ranks.ranked(rows, [day], "_rank")
    size = placed.count()
    edges = [size]
    for fraction in [held_out] if isinstance(held_out, float) else held_out:
        if size < 2:
            raise SeriesError("a temporal split needs at least two rows")
        size = max(1, min(int(size * (1.0 - fraction)), size - 1))
        edges.append(size)
    bounds = [0, *reversed(edges)]
    return [placed.where((F.col("_rank") > a) & (F.col("_rank") <= b)).drop("_rank") for a, b in zip(bounds, bounds[1:])]


def _assembled(rows: DataFrame) -> DataFrame:
    return assemble(rows, NEXT_CLOSE_INPUTS, "next_close")


def linear(rows: DataFrame) -> LinearRegressionModel:
    """The linear learner on next-close rows."""
    return LinearRegression(maxIter=LINEAR_ITERATIONS).fit(_assembled(rows))


def coefficients(model: LinearRegressionModel, spark: SparkSession) -> DataFrame:
    """(input, coefficient), the intercept as an input of that name."""
    found = [*zip(NEXT_CLOSE_INPUTS, map(float, model.coefficients)), ("intercept", float(model.intercept))]
    return spark.createDataFrame(found, "input string, coefficient double")


def _score(predictions: DataFrame) -> dict[str, float]:
    """The evaluator's three measures in one pass. A constant label leaves R² without a
    scale: minus infinity, or undefined when the fit is perfect too."""
    y, p = F.col("label"), F.col("prediction")
    row = predictions.agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"), F.var_pop(y).alias("spread"), (F.min(y) < F.max(y)).alias("varies"),
    ).collect()[0]
    if row["varies"]:
        r2 = 1.0 - row["mse"] / row["spread"]
    else:
        r2 = -math.inf if row["mse"] else math.nan
    return {"rmse": math.sqrt(row["mse"]), "mae": row["mae"], "r2": r2}


@contextmanager
def _packed(rows: DataFrame, most: int = PACKED_ROWS) -> Iterator[DataFrame]:
    """Keep rows for the many passes of a learner, at most about ``most`` in a partition: a file split
    of sorted rows is small on disk and large in memory."""
    total = rows.count()
    if total > most:
        rows = rows.repartition(max(math.ceil(total / most), rows.sparkSession.sparkContext.defaultParallelism))
    kept = rows.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def compare(training: DataFrame, validation: DataFrame) -> tuple[str, Model, DataFrame]:
    """Fit the three learners on next-close rows; the lowest validation RMSE wins, the first on ties.
    Returns its name, the fitted model and the (model, rmse, mae, r2) table."""
    learners = {
        "linear_regression": LinearRegression(maxIter=LINEAR_ITERATIONS),
        "random_forest": RandomForestRegressor(numTrees=FOREST_TREES),
        "gbt": GBTRegressor(maxIter=BOOSTING_ROUNDS),
    }
    with _packed(_assembled(training)) as known, _packed(_assembled(validation)) as unseen:
        fitted = {name: learner.fit(known) for name, learner in learners.items()}
        scored = {name: _score(model.transform(unseen)) for name, model in fitted.items()}
    best = min(scored, key=lambda name: scored[name]["rmse"])
    spark = training.sparkSession
    table = spark.createDataFrame(
        [(name, *[score[m] for m in MEASURES]) for name, score in scored.items()],
        "model string, rmse double, mae double, r2 double",
    )
    return best, fitted[best], table


def held_out_score(model: Model, rows: DataFrame) -> DataFrame:
    """One row with the errors of a fitted model on next-close rows it has not seen."""
    if rows.isEmpty():
        raise SeriesError("no valid test rows after preprocessing")
    score = _score(model.transform(_assembled(rows)))
    return rows.sparkSession.createDataFrame([tuple(score[m] for m in MEASURES)], "rmse double, mae double, r2 double")


def search_one(feature_rows: DataFrame) -> tuple[DataFrame, dict]:
    """The full grid of penalties and iteration limits on one series, with MLlib's own
    optimizer. Returns the attempts and the chosen one, first wins ties."""
    attempts = []
    with _packed(assemble(feature_rows, features.FEATURES, "log_close", ["part"])) as data:
        train, test = data.where(F.col("part") == "train"), data.where(F.col("part") == "test")
        for penalty in ridge.PENALTIES:
            for limit in ridge.ITERATION_LIMITS:
                learner = LinearRegression(maxIter=limit, regParam=penalty, elasticNetParam=0.0, solver="l-bfgs")
                model = learner.fit(train)
                on_test, on_train = _score(model.transform(test)), _score(model.transform(train))
                attempts.append({"epochs": limit, "reg_param": penalty, "train_r2": on_train["r2"], **on_test})

    def objective(attempt: dict) -> float:
        gap = max(0.0, attempt["train_r2"] - attempt["r2"])
        value = -attempt["r2"] + ridge.GAP_WEIGHT * gap + ridge.RMSE_WEIGHT * attempt["rmse"]
        return math.inf if math.isnan(value) else value

    chosen = min(attempts, key=objective)
    columns = ["epochs", "reg_param", "train_r2", "r2", "rmse", "mae"]
    table = feature_rows.sparkSession.createDataFrame(
        [tuple(attempt[name] for name in columns) for attempt in attempts],
        "epochs int, reg_param double, train_r2 double, r2 double, rmse double, mae double",
    )
    return table, chosen
