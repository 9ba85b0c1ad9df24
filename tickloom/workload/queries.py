"""Every registered query: name -> function of (session, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import dates, names, numbers, scores
from tickloom.operators import (
    backtest, charts, features, forecast, inference, learners, ohlcv, profile as profiles, quality, ranks, registry, ridge, series,
    tickers,
)
from tickloom.plans import etl
from tickloom.sources import curated, delimited, exports, fixedwidth, folder as folders, guarded, landing, sinks, versions
from tickloom.sources.shared import materialised, scratch
from tickloom.workload import tables
from tickloom.workload.tables import ORDER, bars, block, raw_quotes, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _rounded(table: DataFrame, columns, places: int = 6) -> DataFrame:
    return table.withColumns({name: F.round(name, places) for name in columns})


def _position_text(table: DataFrame) -> DataFrame:
    return table.withColumn("position", F.col("position").cast("string"))


# Curation and text normalisation


@registered
def ohlcv_bars(spark, folder):
    return bars(spark, folder)


@registered
def ohlcv_curated(spark, folder):
    return ohlcv.curate(raw_quotes(spark, folder), ORDER, block())


@registered
def series_strict(spark, folder):
    return series.treat(raw_quotes(spark, folder), ORDER, "strict").withColumn("date", dates.iso_text(F.col("date")))


@registered
def series_lenient(spark, folder):
    return sinks.for_display(series.treat(raw_quotes(spark, folder), ORDER, "lenient"))


@registered
def date_training(spark, folder):
    text = F.col("trade_date")
    return raw_quotes(spark, folder).groupBy(
        dates.training_date(text).alias("training_date"), dates.padded_date(text).alias("padded_date")
    ).agg(F.count(F.lit(1)).alias("n"))


@registered
def named_month_dates(spark, folder):
    """Ship dates spelled with month names in four ways, some of them no days, and read again."""
    day, key = F.col("l_shipdate").cast("date"), F.col("l_orderkey") % 5
    ways = [F.date_format(day, p) for p in ("d MMM yyyy", "MMMM d, yyyy", "dd-MMM-yyyy", "MMM dd yyyy HH:mm")]
    text = F.get(F.array(*ways, F.concat(F.lit("31 Feb "), F.year(day))), key.cast("int"))
    rows = read(spark, folder, "lineitem").select(text.alias("text"))
    return rows.groupBy("text").agg(F.count(F.lit(1)).alias("n")).select("text", dates.lenient_date(F.col("text")).alias("date"), "n")


@registered
def prev_next_close(spark, folder):
    rows = ohlcv.training_rows(raw_quotes(spark, folder), ORDER, block())
    return rows.dropna(subset=[*learners.NEXT_CLOSE_INPUTS, "next_close"]).select(
        "symbol", "trade_date_fmt", "close", "prev_close", "next_close", "volume"
    )


@registered
def history_between(spark, folder):
    return series.between(bars(spark, folder), [" s1", "S3", "s7 "], "1996-01-01", "1997-06-30")


@registered
def curated_history(spark, folder):
    """A bucketed table, updated for every third supplier, and a history read from it."""
    daily = bars(spark, folder).withColumn("trade_date_fmt", dates.iso_text(F.col("date"))).drop("date")
    path, number = scratch(spark, "curated"), F.substring("symbol", 2, 20).cast("int")
    sinks.write_by_symbol(daily.where("trade_date_fmt < '1996-01-01'"), path, 8)
    later = daily.where((number % 3 == 0) & (F.col("trade_date_fmt") >= "1995-06-01")).withColumn("close", F.col("close") + 1)
    curated.update(later, path, 8)
    return curated.history(spark, path, [f"s{i}" for i in range(1, 41)], "1995-01-01", "1996-12-31", 8)


@registered
def fixed_width_bars(spark, folder):
    quotes = fixedwidth.parse_quotes(tables.fixed_lines(spark, folder))
    return quotes.select(
        "symbol", F.to_date("trade_date").alias("trade_date"),
        *[F.col(name).cast("double").alias(name) for name in ohlcv.PRICES], F.col("volume").cast("bigint").alias("volume"),
    )


@registered
def separator_by_file(spark, folder):
    return delimited.line_separators(tables.price_lines(spark, folder), "path", "place", "text")


@registered
def separator_vote(spark, folder):
    """Per file the separator that cuts its lines most evenly."""
    lines = tables.price_lines(spark, folder).unionByName(tables.layout_lines(spark, folder).withColumn("path", F.concat(F.lit("layout-"), "path")), True)
    return folders.voted_separators(lines, "path", "text")


def _layout_folder(spark, folder):
    files = tables.as_files(tables.layout_lines(spark, folder), "layout-files")
    return delimited.read_folder(spark, files, layout=None, suffix=".txt", recursive=True)


@registered
def folder_ingest(spark, folder):
    """A file per supplier in four layouts, written and read again as one folder."""
    return _layout_folder(spark, folder).table.select("symbol", "date", "close", "volume", "`note 2`", "flag3")


@registered
def folder_findings(spark, folder):
    return _layout_folder(spark, folder).findings.select(
        F.regexp_extract("symbol", "path=([^/]+)/", 1).alias("file"), "check", "severity", "observed"
    )


@registered
def landed_files(spark, folder):
    """Files with carriage returns and broken bytes, landed in pieces and put together again."""
    files = tables.as_files(tables.layout_lines(spark, folder), "raw-files", "\r\n")
    landed = spark.read.parquet(landing.land_raw(spark, files, scratch(spark, "landed"), "raw files", 16_384, recursive=True))
    whole = landing.restored(landed, scratch(spark, "restored")).select("path", "bytes", "sha256")
    counts = landed.groupBy("path").agg(F.count(F.lit(1)).alias("pieces"))
    return whole.join(counts, "path").withColumn("path", F.regexp_extract("path", "path=([^/]+)/", 1))


@registered
def inferred_types(spark, folder):
    return inference.inferred_types(tables.kinds(spark, folder), tables.KINDS)


@registered
def typed_rows(spark, folder):
    """Sums over the typed columns show that every value came through."""
    rows = tables.kinds(spark, folder)
    made = inference.typed(rows, inference.inferred_types(rows, tables.KINDS))
    return made.groupBy("name").agg(
        F.sum("whole").alias("whole"), F.round(F.sum("number"), 2).alias("number"), F.max("day").alias("day"), F.date_format(F.max("moment"), "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.min("mixed").alias("mixed"), F.sum("large").alias("large"), F.count("nothing").alias("nothing"), F.count_if(F.col("bad_day") == "1994-02-30").alias("bad_days"),
    )


@registered
def union_mixed_files(spark, folder):
    """Each file's separator is found from its header and used for its lines; some fields are quoted."""
    written = tables.price_lines(spark, folder).select("path", "place", "text")
    found = delimited.line_separators(written, "path", "place", "text")
    quoted = F.regexp_replace("text", "^(S[0-9]*5)([;,])", '"$1"$2')
    lines = written.where(F.col("place") > 0).withColumn("text", quoted).join(found, "path")
    semicolons = delimited.parse_lines(lines.where(F.col("separator") == ";"), "text", ["symbol", "date", "close"], ";")
    commas = delimited.parse_lines(
        lines.where(F.col("separator") == ","), "text", ["symbol", "date", "close", "volume"], ","
    )
    union = semicolons.unionByName(commas, allowMissingColumns=True)
    return union.select("symbol", "date", numbers.strict_decimal(F.col("close")).alias("close"), "volume")


@registered
def slug(spark, folder):
    named = read(spark, folder, "part").select(F.col("p_name").alias("text")).unionByName(
        read(spark, folder, "customer").select(F.concat(F.lit("__"), "c_name", F.lit("-ç/")).alias("text"))
    )
    return named.select("text", names.slug(F.col("text")).alias("slug"), names.file_prefix(F.col("text")).alias("prefix"))


# Symbols and quality


@registered
def first_seen_symbols(spark, folder):
    return _position_text(tickers.first_seen(raw_quotes(spark, folder), ORDER))


@registered
def drop_nth_symbol(spark, folder):
    kept = tickers.drop_nth_symbol(raw_quotes(spark, folder), ORDER)
    return _position_text(kept.select("position", "symbol", "trade_date", "close"))


@registered
def dropped_ticker_report(spark, folder):
    return quality.dropped_ticker_findings(raw_quotes(spark, folder), ORDER)


@registered
def symbol_counts(spark, folder):
    return tickers.symbol_counts(bars(spark, folder))


@registered
def top_symbol(spark, folder):
    return tickers.top_symbols(bars(spark, folder), 1)


@registered
def primary_symbol(spark, folder):
    return tickers.only_primary_symbol(bars(spark, folder)).select("symbol", "date", "close")


@registered
def quality_report(spark, folder):
    parsed = series.parse_series(raw_quotes(spark, folder), ORDER)
    return quality.series_report(parsed, ORDER)


@registered
def guarded_findings(spark, folder):
    """Quotes written under expectations: how many rows break each, as counted by the one write."""
    return etl.write_quotes(raw_quotes(spark, folder), scratch(spark, "quotes"), input_order=ORDER).to_frame(spark)


@registered
def guarded_quotes(spark, folder):
    """Quotes written under expectations and read back: the kept rows, and those in quarantine with what they break."""
    quotes = raw_quotes(spark, folder)
    made = etl.write_quotes(quotes, scratch(spark, "quotes"), input_order=ORDER)
    parsed = series.parse_series(quotes, ORDER)
    kept = guarded.read(parsed, made.path).withColumn("broken", F.lit(None).cast("array<string>"))
    rows = kept.unionByName(guarded.read(parsed, made.quarantine, quarantined=True))
    return _position_text(rows.select("symbol", "date", "close", "position", F.array_join("broken", ",").alias("broken")))


@registered
def ticker_report(spark, folder):
    files = raw_quotes(spark, folder).withColumn("source", F.concat(F.lit("file-"), F.pmod("position", F.lit(50)).cast("bigint")))
    return quality.ticker_findings(files, "source")


# Exploration


@registered
def top_symbol_close_trend(spark, folder):
    return _rounded(charts.trend(bars(spark, folder), "close"), ["close"])


@registered
def top_symbol_volume_trend(spark, folder):
    return _rounded(charts.trend(bars(spark, folder), "volume"), ["volume"])


@registered
def symbol_ohlc_frame(spark, folder):
    return charts.symbol_frame(bars(spark, folder), "S3", check=False)


@registered
def profile(spark, folder):
    table = bars(spark, folder)
    found = profiles.profile(table)
    return _rounded(found, ["mean", "std", "min", "q25", "q50", "q75", "max"])


def _correlated(spark, folder) -> tuple[DataFrame, list[str]]:
    """The curated quotes with a column that does not vary beside the measured ones."""
    table = ohlcv.curate(raw_quotes(spark, folder), ORDER, block()).withColumn("unit", F.lit(1.0))
    return table, [*profiles.CORRELATED, "unit"]


@registered
def correlation_matrix(spark, folder):
    return _rounded(profiles.correlation_matrix(*_correlated(spark, folder)), ["correlation"])


@registered
def correlation_chart(spark, folder):
    return charts.correlation_chart(*_correlated(spark, folder)).select("x", "y", "label")


# Features, split, baseline


def _model_series(spark, folder) -> DataFrame:
    return features.model_input(bars(spark, folder))


def _features(spark, folder) -> DataFrame:
    return features.trainable(features.temporal_features(_model_series(spark, folder)))


@registered
def model_input_text(spark, folder):
    """Text quotes with blank tickers and several rows a day: month-first dates, the last row wins."""
    text = raw_quotes(spark, folder).withColumnsRenamed({"symbol": "Ticker", "trade_date": " DATE ", "close": "Fechamento"})
    return features.model_input(text, "zed4 ", ORDER).select("symbol", "date", "close", "high", "low", "volume")


@registered
def temporal_features(spark, folder):
    built = features.temporal_features(_model_series(spark, folder)).select(
        "symbol", "date", "close", "day_index", "scale", *features.FEATURES, "log_close", "part"
    )
    return _rounded(built, [*features.FEATURES, "log_close"])


@registered
def temporal_split(spark, folder):
    split = features.temporal_split(_model_series(spark, folder))
    return split.groupBy("symbol", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first"), F.max("date").alias("last")
    )


@registered
def series_status(spark, folder):
    """Series of all lengths: each symbol's half years, quarters and months count as series of their own."""
    month = F.month("date")
    span = F.when(month <= 6, F.lit("H1")).when(month <= 9, F.lit("Q3")).otherwise(month.cast("string"))
    parts = _model_series(spark, folder).withColumn("symbol", F.concat_ws("-", "symbol", F.year("date"), span))
    return features.series_status(parts, features.temporal_features(parts))


def _test_rows(spark, folder) -> DataFrame:
    """Test rows with the mean of the last seven log closes standing in for the model."""
    rows = _features(spark, folder).withColumn("predicted", F.expm1("rolling_mean_7"))
    return rows.where(F.col("part") == "test")


@registered
def naive_baseline(spark, folder):
    return _test_rows(spark, folder).select("symbol", "date", "close", "naive")


@registered
def naive_metrics(spark, folder):
    return _rounded(backtest.regression_metrics(_test_rows(spark, folder), ["symbol"], "close", "naive"), ["rmse", "mae", "r2"])


_ERRORS = [f"{who}_{name}" for who in ("model", "naive") for name in ("rmse", "mae", "r2")]


@registered
def backtest_folds(spark, folder):
    return _rounded(backtest.fold_metrics(_test_rows(spark, folder)), _ERRORS)


@registered
def backtest_summary(spark, folder):
    summary = backtest.fold_summary(backtest.fold_metrics(_test_rows(spark, folder)))
    return _rounded(summary, ["model_rmse_mean", "naive_rmse_mean"])


@registered
def calibrated_predictions(spark, folder):
    """A close follower of the actual values, so that most series exceed the band."""
    rows = _test_rows(spark, folder).withColumn("predicted", F.col("close") * 0.75 + F.col("predicted") * 0.25)
    damped = backtest.calibrate(rows, ["symbol"]).select(
        "symbol", "date", "close", "predicted", "calibrated", "calibrated_r2",
        scores.distance_to_band(F.col("calibrated_r2")).alias("distance"),
    )
    return _rounded(damped, ["predicted", "calibrated", "calibrated_r2", "distance"], 5)


# Model


@registered
def ridge_moments(spark, folder):
    parts = ridge.moments(_features(spark, folder))
    return parts.select(
        "symbol", "part", "n", F.round("center", 6).alias("center"),
        *[F.round(F.col("sums")[i], 4).alias(f"sum_{name}") for i, name in enumerate((*features.FEATURES, "log_close"))],
        F.round(F.col("products")[9], 4).alias("t_by_label"),
        F.round(F.col("products")[54], 4).alias("label_by_label"),
    )


@registered
def ridge_search(spark, folder):
    return _rounded(ridge.search_grid(_features(spark, folder)), ["train_r2", "r2", "rmse", "mae"], 5)


@registered
def ridge_refit(spark, folder):
    models = ridge.with_chosen(ridge.fit_all(_features(spark, folder)))
    coefficients = {
        f"{kind}_{name}": F.round(F.col(column)[i], 5)
        for kind, column in (("train", "beta"), ("full", "full_beta"))
        for i, name in enumerate(features.FEATURES)
    }
    return models.select(
        "symbol", "train_rows", "test_rows", "scale", "first_date", "last_date", "reg_param",
        F.round("intercept", 4).alias("train_intercept"), F.round("full_intercept", 4).alias("full_intercept"),
        *[value.alias(name) for name, value in coefficients.items()],
    )


FIXED_BETA = (0.02, -0.01, 0.03, 0.4, 0.2, 0.1, 0.2, -0.05, 0.1)
FIXED_INTERCEPT = 1.0


@registered
def recursive_forecast_fixed(spark, folder):
    rows = _features(spark, folder)
    tails = ridge._pivot(ridge.moments(rows))
    models = tails.withColumns(
        {"full_beta": F.array(*[F.lit(b) for b in FIXED_BETA]), "full_intercept": F.lit(FIXED_INTERCEPT)}
    )
    return _rounded(forecast.future_path(models, 10), ["predicted"], 4)


def _forecast(spark, folder) -> forecast.Forecast:
    return forecast.forecast_all(_model_series(spark, folder))


@registered
def forecast_all(spark, folder):
    record = _forecast(spark, folder).metrics
    flat = record.select(
        *[name for name in record.columns if name not in ("backtest_folds", "backtest_summary", "feature_set")],
        "backtest_summary.*", F.size("feature_set").alias("features"),
    )
    measures = ["train_r2", "r2", "test_r2", "rmse", "mae", "baseline_naive_rmse", "baseline_naive_mae", "baseline_naive_r2"]
    return _rounded(flat, [*measures, "model_rmse_mean", "naive_rmse_mean"], 4)


def _exported(spark, folder) -> str:
    made, root = forecast.forecast_all(_model_series(spark, folder), keep=materialised), scratch(spark, "exports")
    sinks.write_forecast(made, made.metrics.select("symbol", F.concat(F.lit("run-"), "symbol").alias("run_key")), root)
    return root


@registered
def forecast_test_metrics(spark, folder):
    """The exported test metrics, with the order of their keys."""
    found = exports.test_metrics(spark, _exported(spark, folder))
    return _rounded(found, ["train_r2", "test_r2", "rmse", "mae"], 4)


@registered
def forecast_exports(spark, folder):
    """Exports read back, gathered to a nested record per run, which goes through its JSON text."""
    whole = exports.read_exports(spark, _exported(spark, folder))
    record = exports.as_text(exports.records(whole)).select(exports.from_text(F.col("value")).alias("r")).select("r.*")
    sizes = [whole.train.groupBy("run_key").agg(F.count(F.lit(1)).alias("train_rows")), whole.test.groupBy("run_key").agg(F.count(F.lit(1)).alias("test_rows"))]
    flat = record.join(sizes[0], "run_key").join(sizes[1], "run_key").select(
        "run_key", "symbol", "train_rows", "test_rows", F.size("search").alias("attempts"), F.size("past").alias("past_rows"),
        F.element_at("past", 1)["date"].alias("past_first"), F.size("future").alias("future_rows"), F.element_at("future", -1)["date"].alias("future_last"),
        F.size("metrics.backtest_folds").alias("folds"), F.aggregate("metrics.backtest_folds", F.lit(0).cast("long"), lambda a, f: a + f["rows"]).alias("fold_rows"),
        F.element_at(F.filter("search", lambda a: a["chosen"]), 1)["reg_param"].alias("reg_param"), "metrics.epochs", "metrics.rmse",
    )
    return _rounded(flat, ["rmse"], 4)


@registered
def forecast_folds(spark, folder):
    folds = _forecast(spark, folder).metrics.select("symbol", F.inline("backtest_folds"))
    return _rounded(folds, _ERRORS, 4)


@registered
def forecast_past(spark, folder):
    return _rounded(_forecast(spark, folder).past, ["predicted"], 3)


@registered
def forecast_future(spark, folder):
    return _rounded(_forecast(spark, folder).future, ["predicted"], 3)


@registered
def forecast_chart(spark, folder):
    series_rows = _model_series(spark, folder)
    made = forecast.forecast_all(series_rows)
    return _rounded(charts.forecast_overlay(series_rows, made.past, made.future, made.horizon_days), ["value"], 3)


def _next_close(spark, folder) -> DataFrame:
    daily = bars(spark, folder).withColumn("trade_date", dates.iso_text(F.col("date")))
    return learners.next_close_rows(ohlcv.daily_training_rows(daily))


@registered
def next_close_split(spark, folder):
    """Raw rows, several per symbol and day, ranked over the whole set."""
    parts = zip(("fit", "validation", "held_out"), learners.split_by_rank(prev_next_close(spark, folder), (0.2, 0.2)))
    tagged = [rows.withColumn("part", F.lit(part)) for part, rows in parts]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@registered
def next_close_ranks(spark, folder):
    return ranks.ranked(prev_next_close(spark, folder), ["trade_date_fmt"])


@registered
def next_close_linear(spark, folder):
    fit_rows, _, _ = learners.split_by_rank(_next_close(spark, folder), (0.2, 0.2))
    return _rounded(learners.coefficients(learners.linear(fit_rows), spark), ["coefficient"], 4)


@registered
def next_close_linear_score(spark, folder):
    fit_rows, validation, _ = learners.split_by_rank(_next_close(spark, folder), (0.2, 0.2))
    return _rounded(learners.held_out_score(learners.linear(fit_rows), validation), learners.MEASURES, 4)


@registered
def model_comparison(spark, folder):
    return learners.compare(*learners.split_by_rank(_next_close(spark, folder)))[2]


@registered
def final_score(spark, folder):
    fit_rows, validation, held_out = learners.split_by_rank(_next_close(spark, folder), (0.2, 0.2))
    _, model, _ = learners.compare(fit_rows, validation)
    return learners.held_out_score(model, held_out)


# Run registry


@registered
def series_fingerprint(spark, folder):
    return registry.fingerprints(_model_series(spark, folder), "demo", 0.2, 31)


@registered
def run_counts(spark, folder):
    return registry.attempt_counts(tables.runs(spark, folder))


@registered
def latest_runs(spark, folder):
    return registry.latest_runs(tables.runs(spark, folder)).select("run_key", "symbol", "run_number", "updated_at")


@registered
def retained_runs(spark, folder):
    """Each key registered twice, some runs without an action: what the registry keeps."""
    registered_runs = tables.runs(spark, folder).withColumn("run_key", F.concat(F.lit("run-"), F.floor(F.col("run_number") / 2)))
    action = F.when(F.col("run_number") % 5 > 1, F.concat(F.lit("a-"), F.col("run_number") % 97))
    return registry.retained_runs(registered_runs.withColumn("action_key", action))


@registered
def valid_runs(spark, folder):
    return registry.valid_runs(tables.runs(spark, folder), tables.artifacts(spark, folder)).select("run_key", "symbol")


@registered
def registry_versions(spark, folder):
    """Runs registered in four appends, each key several times, with a compaction in between."""
    root, given = scratch(spark, "registry"), tables.runs(spark, folder).withColumn("run_key", F.concat(F.lit("run-"), F.floor(F.col("run_number") / 3)))
    how = (registry.RUN_SCHEMA, "run_key", ["updated_at", "run_number"])
    for i in range(4):
        versions.append(given.where(F.col("run_number") % 4 == i), root)
        if i == 1:
            versions.compact(spark, root, *how)
    return versions.read(spark, root, *how)


@registered
def cached_results(spark, folder):
    """Metrics of planned runs: those of reused runs are there already, the others are made up for the plan."""
    given, plan = tables.runs(spark, folder), materialised(reuse_plan(spark, folder))
    known = given.select("run_key", F.col("run_number").cast("double").alias("rmse"), "symbol")
    fresh = plan.where("decision = 'train'").select("run_key", F.lit(-1.0).alias("rmse"), "symbol")
    return registry.planned_results(plan, known.unionByName(fresh), registry.attempt_counts(given))


@registered
def reuse_plan(spark, folder):
    runs = tables.runs(spark, folder)
    wanted = runs.select("symbol").distinct().withColumn("action_key", F.concat(F.lit("a-"), "symbol"))
    return registry.reuse_plan(wanted, registry.valid_runs(runs, tables.artifacts(spark, folder)))
