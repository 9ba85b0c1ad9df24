"""Run registry kept as tables: attempts (one row per request) and runs (one row per
finished forecast). Keeping the latest runs is a ranked filter, which Spark applies
before the shuffle, and all counts are partial aggregates, so a ticker with very many
runs never meets in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Runs kept per ticker or action, and the artifacts a usable run must have.
MAX_RUNS = 7
REQUIRED_ARTIFACTS = ("training_metrics", "test_predictions", "future_predictions")

RUN_SCHEMA = (
    "run_key string, symbol string, action_key string, run_number int, updated_at timestamp, source_name string"
)
_LANES = 4
_LANE_DIGITS = 15


def fingerprints(series: DataFrame, source_name: Column | str, held_out: float, days: int) -> DataFrame:
    """(symbol, action_key): equal exactly when the series' rows and the parameters are equal.

    Each row is hashed by itself and the hashes are added up in four 60-bit lanes, so the
    key needs neither an ordering nor all rows of a symbol in one place.
    """
    source = F.lit(source_name) if isinstance(source_name, str) else source_name

    def fixed(name: str) -> Column:
        return F.coalesce(F.round(F.col(name), 8).cast("decimal(38,8)").cast("string"), F.lit("-"))

    row_text = F.concat_ws("|", F.date_format("date", "yyyy-MM-dd"), *[fixed(n) for n in ("close", "high", "low", "volume")])
    digest = F.sha2(row_text, 256)
    lanes = [
        F.conv(F.substring(digest, 1 + i * _LANE_DIGITS, _LANE_DIGITS), 16, 10).cast("bigint") for i in range(_LANES)
    ]
    totals = series.select("symbol", "date", *[lane.alias(f"_lane{i}") for i, lane in enumerate(lanes)]).groupBy("symbol").agg(
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.col(f"_lane{i}").cast("decimal(19,0)")).alias(f"_lane{i}") for i in range(_LANES)],
    )
    key = F.concat_ws(
        "|",
        F.upper("symbol"),
        F.date_format("_first", "yyyy-MM-dd"),
        F.date_format("_last", "yyyy-MM-dd"),
        F.col("_rows").cast("string"),
        F.lit(str(max(1, int(days)))),
        F.lit(f"{held_out:.8f}"),
        F.upper(F.trim(source)),
        *[F.col(f"_lane{i}").cast("string") for i in range(_LANES)],
    )
    return totals.select("symbol", F.sha2(key, 256).alias("action_key"))


def run_key(action_key: Column, number: Column) -> Column:
    return F.concat(action_key, F.lit("::run-"), number.cast("string"))


def attempt_counts(attempts: DataFrame, symbol: str = "symbol", at: str = "updated_at") -> DataFrame:
    """Processing attempts per ticker: total, capped count and whether the cap is reached."""
    counted = attempts.groupBy(symbol).agg(F.count(F.lit(1)).alias("total"), F.max(at).alias("updated_at"))
    return counted.withColumns(
        {
            "effective": F.least(F.col("total"), F.lit(MAX_RUNS)),
            "limit_reached": F.col("total") >= MAX_RUNS,
        }
    )


def latest_runs(
    runs: DataFrame, by: Sequence[str] = ("symbol",), at: Sequence[str] = ("updated_at", "run_key"), keep: int | None = None
) -> DataFrame:
    """The newest ``keep`` (by default ``MAX_RUNS``) runs of every group. A literal rank bound lets Spark cut each
    task's rows to ``keep`` per group before they are shuffled."""
    newest = Window.partitionBy(*by).orderBy(*[F.desc(name) for name in at])
    return runs.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= (keep or MAX_RUNS)).drop("_rank")


def retained_runs(runs: DataFrame) -> DataFrame:
    """Registered runs that are still kept: one row per key (the newest registration wins),
    among the newest of their ticker and of their action."""
    columns = runs.columns
    newest = runs.groupBy("run_key").agg(
        F.max(F.struct("updated_at", *[name for name in columns if name not in ("run_key", "updated_at")])).alias("_run")
    ).select("run_key", "_run.*").select(*columns)
    of_ticker = latest_runs(newest)
    # Actions are rarer than tickers' runs by now: at most MAX_RUNS rows per ticker remain.
    named = latest_runs(of_ticker.where(F.col("action_key").isNotNull()), by=("action_key",))
    return named.unionByName(of_ticker.where(F.col("action_key").isNull()))


def valid_runs(runs: DataFrame, artifacts: dict[str, DataFrame], key: str = "run_key") -> DataFrame:
    """Runs for which every required artifact table holds rows."""
    missing = [name for name in REQUIRED_ARTIFACTS if name not in artifacts]
    if missing:
        raise ValueError(f"artifact tables not given: {', '.join(missing)}")
    for name in REQUIRED_ARTIFACTS:
        runs = runs.join(artifacts[name].select(key).distinct(), key, "left_semi")
    return runs


def reuse_plan(wanted: DataFrame, valid: DataFrame, reuse: str = "ticker") -> DataFrame:
    """Per wanted symbol whether to ``reuse`` its latest run or ``train`` a new one.

    ``wanted`` has symbol and action_key. With ``reuse="ticker"`` a ticker that has the
    full number of valid runs gets its latest one back whatever the data; with
    ``"fingerprint"`` only runs of the same action count. New runs get the next number.
    """
    group = {"ticker": "symbol", "fingerprint": "action_key"}[reuse]
    full = (
        latest_runs(valid, (group,))
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("valid_runs"),
            F.max_by("run_key", F.struct("updated_at", "run_key")).alias("latest"),
        )
    )
    numbers = valid.groupBy("action_key").agg(F.max("run_number").alias("_last_number"))
    planned = wanted.join(full, group, "left").join(numbers, "action_key", "left")
    count = F.coalesce("valid_runs", F.lit(0))
    reused = count >= MAX_RUNS
    number = (F.coalesce("_last_number", F.lit(0)) + 1).cast("int")
    return planned.select(
        "symbol",
        "action_key",
        count.alias("valid_runs"),
        F.when(reused, "reuse").otherwise("train").alias("decision"),
        F.when(~reused, number).alias("run_number"),
        F.when(reused, F.col("latest")).otherwise(run_key(F.col("action_key"), number)).alias("run_key"),
    )


def planned_results(plan: DataFrame, metrics: DataFrame, counts: DataFrame) -> DataFrame:
    """Metrics of the planned runs, each marked as new or as one that was there before.

    ``plan`` is ``reuse_plan``'s, ``counts`` ``attempt_counts``'. The cap is reported as
    reached only where it made the run come from the registry.
    """
    chosen = plan.select("run_key", "decision", "action_key", "valid_runs")
    processed = counts.select(
        "symbol", F.col("effective").alias("ticker_reprocess_count"), F.col("total").alias("ticker_processing_count_total"), "limit_reached"
    )
    cached = F.col("decision") == "reuse"
    return (
        metrics.join(chosen, "run_key").join(processed, "symbol")
        .withColumn("from_cache", cached)
        .withColumn("cache_limit_reached", cached & F.col("limit_reached"))
        .withColumn("action_reprocess_count", F.least(F.col("valid_runs") + F.when(cached, 0).otherwise(1), F.lit(MAX_RUNS)))
        .withColumn("max_action_reprocessings", F.lit(MAX_RUNS))
        .drop("decision", "valid_runs", "limit_reached")
    )
