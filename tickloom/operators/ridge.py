"""Ridge regression for every series at once.

The fit needs only second moments, which Spark sums per (symbol, part) with plain
codegen'd aggregates. A small Arrow UDF then solves one 9x9 system per symbol and
penalty; it sees one row per symbol, never the observations.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.features import FEATURES

# Penalties searched, the iteration limits tried with each of them by the full grid,
# and the weights of the objective.
PENALTIES = (0.001, 0.01, 0.1)
ITERATION_LIMITS = (8, 16, 32, 64, 128)
GAP_WEIGHT = 0.15
RMSE_WEIGHT = 0.005
TAIL = 7

_CENTRED = {"lag_1", "lag_2", "lag_3", "rolling_mean_7", "log_close"}
_NAMES = (*FEATURES, "log_close")


def moments(features: DataFrame) -> DataFrame:
    """Per (symbol, part): row count, sums and sums of products of features and label.

    Price levels enter relative to the series' mean log close (``center``), which keeps
    the products well scaled. The sums reuse the partitioning of the feature windows.
    """

    def value(name: str) -> Column:
        return F.col(name) - F.col("center") if name in _CENTRED else F.col(name)

    shifted = features.withColumns({f"_x{i}": value(name) for i, name in enumerate(_NAMES)})
    size = len(_NAMES)
    sums = [F.sum(f"_x{i}").alias(f"_s{i}") for i in range(size)]
    products = [
        F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_p{i}_{j}") for i in range(size) for j in range(i, size)
    ]
    back = F.col("feature_rows") - F.col("place")
    tail = [F.max(F.when(back == k, F.col("log_close"))).alias(f"_tail{k}") for k in range(TAIL)]
    carried = [F.max(name).alias(name) for name in ("center", "scale", "first_date", "last_date", "feature_rows")]
    carried += [F.array(F.min("log_close"), F.max("log_close")).alias("label_range")]
    grouped = shifted.groupBy("symbol", "part").agg(F.count(F.lit(1)).alias("n"), *sums, *products, *tail, *carried)
    return grouped.select(
        "symbol",
        "part",
        "n",
        F.array(*[f"_s{i}" for i in range(size)]).alias("sums"),
        F.array(*[f"_p{i}_{j}" for i in range(size) for j in range(i, size)]).alias("products"),
        *[f"_tail{k}" for k in range(TAIL)],
        "center",
        "scale",
        "first_date",
        "last_date",
        "label_range",
    )


def _pivot(parts: DataFrame) -> DataFrame:
    """Train and test moments of a symbol side by side (two rows in, one out)."""
    carried = [F.max(name).alias(name) for name in ("center", "scale", "first_date", "last_date")]
    tail = [F.max(f"_tail{k}").alias(f"_tail{k}") for k in range(TAIL)]
    sides = [
        F.max(F.when(F.col("part") == part, F.col(name))).alias(f"{part}_{name}")
        for part in ("train", "test")
        for name in ("n", "sums", "products", "label_range")
    ]
    return (
        parts.groupBy("symbol")
        .agg(*sides, *tail, *carried)
        .withColumn("tail", F.array(*[f"_tail{k}" for k in reversed(range(TAIL))]))
        .drop(*[f"_tail{k}" for k in range(TAIL)])
    )


def _central(n: float, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and the sum-of-squares matrix about them."""
    size = len(sums)
    raw = np.zeros((size, size))
    raw[np.triu_indices(size)] = products
    raw = raw + np.triu(raw, 1).T
    means = sums / n
    return means, raw - n * np.outer(means, means)


def _newton(system: np.ndarray, target: np.ndarray, limit: int) -> np.ndarray:
    """At most ``limit`` Newton steps from 0 on the fit's quadratic. The first is the solution up to rounding,
    later ones correct it; what no longer halves the step is rounding and ends the fit."""
    weights = np.linalg.solve(system, target)
    before = np.linalg.norm(weights)
    for _ in range(limit - 1):
        step = np.linalg.solve(system, target - system @ weights)
        length = np.linalg.norm(step)
        if not length < before / 2:
            break
        weights, before = weights + step, length
    return weights


def _solve(
    n: float, means: np.ndarray, scatter: np.ndarray, penalty: float, constant: bool, limit: int = 1
) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the penalised fit on standardised inputs; none for a constant label."""
    label = len(means) - 1
    variance = np.clip(np.diag(scatter), 0.0, None) / max(n - 1.0, 1.0)
    spread = np.sqrt(variance)
    floor = 1e-12 * np.maximum(1.0, np.abs(means))
    beta = np.zeros(label)
    if not constant and spread[label] > floor[label]:
        used = np.flatnonzero(spread[:label] > floor[:label])
        if used.size:
            scaled = scatter[np.ix_(used, used)] / np.outer(spread[used], spread[used]) / n
            target = scatter[used, label] / (spread[used] * spread[label]) / n
            system = scaled + (penalty / spread[label]) * np.eye(used.size)
            beta[used] = _newton(system, target, limit) * spread[label] / spread[used]
    return beta, float(means[label] - means[:label] @ beta)


def _errors(
    n: float, means: np.ndarray, scatter: np.ndarray, beta: np.ndarray, intercept: float, constant: bool
) -> tuple[float, float]:
    """R² and RMSE of a linear rule on the rows behind the moments. A constant label, told by
    its range (its sum of squares is a rounding residue), has no R²."""
    label = len(means) - 1
    rule = np.append(-beta, 1.0)
    bias = means[label] - means[:label] @ beta - intercept
    sse = max(float(rule @ scatter @ rule), 0.0) + n * bias * bias
    total = float(scatter[label, label])
    r2 = 1.0 - sse / total if not constant and total > 0 else float("nan")
    return r2, float(np.sqrt(sse / n))


_FIT_TYPE = (
    "reg_param array<double>, train_r2 array<double>, r2 array<double>, rmse array<double>, "
    "beta array<array<double>>, intercept array<double>, chosen int, "
    "full_beta array<double>, full_intercept double"
)


def _objective(train_r2: float, r2: float, rmse: float) -> float:
    """What the search makes small; an undefined one never wins over a defined one."""
    value = -r2 + GAP_WEIGHT * max(0.0, train_r2 - r2) + RMSE_WEIGHT * rmse
    return np.inf if np.isnan(value) else value


def _uncentred(beta: np.ndarray, intercept: float, center: float) -> float:
    levels = np.array([1.0 if name in _CENTRED else 0.0 for name in FEATURES])
    return float(intercept + center - center * (levels @ beta))


def _fit_one(train, test, center: float) -> dict:
    n_train, n_test = float(train[0]), float(test[0])
    full = [train[i] + test[i] for i in range(3)]
    train_moments = _central(n_train, train[1], train[2])
    test_moments = _central(n_test, test[1], test[2])
    flat_train, flat_test = train[3][0] == train[3][1], test[3][0] == test[3][1]
    flat = min(train[3][0], test[3][0]) == max(train[3][1], test[3][1])
    attempts = []
    for penalty in PENALTIES:
        beta, intercept = _solve(n_train, *train_moments, penalty, flat_train)
        train_r2, _ = _errors(n_train, *train_moments, beta, intercept, flat_train)
        r2, rmse = _errors(n_test, *test_moments, beta, intercept, flat_test)
        attempts.append((beta, intercept, train_r2, r2, rmse))
    # Python's min keeps the first of equals.
    chosen = min(range(len(attempts)), key=lambda i: _objective(*attempts[i][2:]))
    full_beta, full_intercept = _solve(float(full[0]), *_central(float(full[0]), full[1], full[2]), PENALTIES[chosen], flat)

    return {
        "reg_param": list(PENALTIES),
        "train_r2": [a[2] for a in attempts],
        "r2": [a[3] for a in attempts],
        "rmse": [a[4] for a in attempts],
        "beta": [a[0].tolist() for a in attempts],
        "intercept": [_uncentred(a[0], a[1], center) for a in attempts],
        "chosen": chosen,
        "full_beta": full_beta.tolist(),
        "full_intercept": _uncentred(full_beta, full_intercept, center),
    }


def _fit_batch(
    train_n: pd.Series, train_sums: pd.Series, train_products: pd.Series, train_range: pd.Series,
    test_n: pd.Series, test_sums: pd.Series, test_products: pd.Series, test_range: pd.Series, center: pd.Series,
) -> pd.DataFrame:
    train = zip(train_n, map(np.asarray, train_sums), map(np.asarray, train_products), train_range)
    test = zip(test_n, map(np.asarray, test_sums), map(np.asarray, test_products), test_range)
    rows = [_fit_one(a, b, c) for a, b, c in zip(train, test, center)]
    columns = [part.split()[0] for part in _FIT_TYPE.split(", ")]
    return pd.DataFrame(rows, columns=columns)


def fit_all(features: DataFrame) -> DataFrame:
    """One row per symbol: every candidate's fit on the training part, the chosen one, and
    the refit on all rows, plus what the forecast starts from (tail, scale, dates)."""
    fit = F.pandas_udf(_fit_batch, _FIT_TYPE)(
        "train_n", "train_sums", "train_products", "train_label_range",
        "test_n", "test_sums", "test_products", "test_label_range", "center",
    )
    both = _pivot(moments(features)).where(F.col("train_n").isNotNull() & F.col("test_n").isNotNull())
    return both.select(
        "symbol",
        F.col("train_n").alias("train_rows"),
        F.col("test_n").alias("test_rows"),
        "tail",
        "scale",
        "first_date",
        "last_date",
        fit.alias("fit"),
    )


def linear_rule(beta: Column, intercept: Column, size: int = len(FEATURES)) -> Column:
    """The fitted rule over the feature columns, inside codegen."""
    total = intercept
    for i, name in enumerate(FEATURES[:size]):
        total = total + beta.getItem(i) * F.col(name)
    return total


def with_chosen(fits: DataFrame) -> DataFrame:
    """Flatten the chosen candidate and the refit; drop the other candidates."""
    index = F.col("fit.chosen")
    return fits.select(
        *[name for name in fits.columns if name != "fit"],
        F.get("fit.reg_param", index).alias("reg_param"),
        F.get("fit.beta", index).alias("beta"),
        F.get("fit.intercept", index).alias("intercept"),
        F.col("fit.full_beta").alias("full_beta"),
        F.col("fit.full_intercept").alias("full_intercept"),
    )


def search_attempts(features: DataFrame, fits: DataFrame) -> DataFrame:
    """Every candidate of every symbol with its log-scale errors: a row per penalty. A fit on
    the moments is solved exactly, without iterations, so ``epochs`` is null. The absolute
    error is the only measure that needs the rows; all candidates share that pass."""
    candidates = range(len(PENALTIES))
    scored = features.where(F.col("part") == "test").join(fits.select("symbol", "fit"), "symbol")
    error = [
        F.avg(F.abs(F.col("log_close") - linear_rule(F.col("fit.beta").getItem(i), F.col("fit.intercept").getItem(i))))
        for i in candidates
    ]
    maes = scored.groupBy("symbol").agg(F.array(*error).alias("mae"))
    zipped = F.arrays_zip(
        F.col("fit.reg_param").alias("reg_param"), F.col("fit.train_r2").alias("train_r2"), F.col("fit.r2").alias("r2"),
        F.col("fit.rmse").alias("rmse"), F.col("mae").alias("mae"),
    )
    return fits.join(maes, "symbol").select(
        "symbol", F.col("fit.chosen").alias("_chosen"), F.posexplode(zipped).alias("_candidate", "_attempt")
    ).select("symbol", F.lit(None).cast("int").alias("epochs"), "_attempt.*", (F.col("_candidate") == F.col("_chosen")).alias("chosen"))


_GRID_TYPE = (
    "epochs array<int>, reg_param array<double>, train_r2 array<double>, r2 array<double>, rmse array<double>, "
    "beta array<array<double>>, intercept array<double>, chosen int"
)


def _grid_one(train, test, center: float) -> list:
    n_train, n_test = float(train[0]), float(test[0])
    train_moments, test_moments = _central(n_train, train[1], train[2]), _central(n_test, test[1], test[2])
    flat_train, flat_test = train[3][0] == train[3][1], test[3][0] == test[3][1]
    attempts = []
    for penalty in PENALTIES:
        for limit in ITERATION_LIMITS:
            beta, intercept = _solve(n_train, *train_moments, penalty, flat_train, limit)
            train_r2, _ = _errors(n_train, *train_moments, beta, intercept, flat_train)
            r2, rmse = _errors(n_test, *test_moments, beta, intercept, flat_test)
            attempts.append((limit, penalty, train_r2, r2, rmse, beta.tolist(), _uncentred(beta, intercept, center)))
    chosen = min(range(len(attempts)), key=lambda i: _objective(*attempts[i][2:5]))
    return [*map(list, zip(*attempts)), chosen]


def _grid_batch(
    train_n: pd.Series, train_sums: pd.Series, train_products: pd.Series, train_range: pd.Series,
    test_n: pd.Series, test_sums: pd.Series, test_products: pd.Series, test_range: pd.Series, center: pd.Series,
) -> pd.DataFrame:
    train = zip(train_n, map(np.asarray, train_sums), map(np.asarray, train_products), train_range)
    test = zip(test_n, map(np.asarray, test_sums), map(np.asarray, test_products), test_range)
    rows = [_grid_one(a, b, c) for a, b, c in zip(train, test, center)]
    return pd.DataFrame(rows, columns=[part.split()[0] for part in _GRID_TYPE.split(", ")])


def search_grid(features: DataFrame) -> DataFrame:
    """The full search of every symbol: a row per penalty and iteration limit, each fitted, scored and
    held against the test rows on its own; the first of equal objectives is chosen. Fits on moments
    converge within the smallest limit, so the points of a penalty agree."""
    fit = F.pandas_udf(_grid_batch, _GRID_TYPE)(
        "train_n", "train_sums", "train_products", "train_label_range",
        "test_n", "test_sums", "test_products", "test_label_range", "center",
    )
    both = _pivot(moments(features)).where(F.col("train_n").isNotNull() & F.col("test_n").isNotNull())
    fits = both.select("symbol", fit.alias("fit"))
    scored = features.where(F.col("part") == "test").join(fits, "symbol")
    error = [
        F.avg(F.abs(F.col("log_close") - linear_rule(F.col("fit.beta").getItem(i), F.col("fit.intercept").getItem(i))))
        for i in range(len(PENALTIES) * len(ITERATION_LIMITS))
    ]
    maes = scored.groupBy("symbol").agg(F.array(*error).alias("mae"))
    names = ("epochs", "reg_param", "train_r2", "r2", "rmse")
    zipped = F.arrays_zip(*[F.col(f"fit.{name}").alias(name) for name in names], F.col("mae").alias("mae"))
    return fits.join(maes, "symbol").select(
        "symbol", F.col("fit.chosen").alias("_chosen"), F.posexplode(zipped).alias("_place", "_attempt")
    ).select("symbol", "_attempt.*", (F.col("_place") == F.col("_chosen")).alias("chosen"))
