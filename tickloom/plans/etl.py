"""From raw files to curated tables and treated series."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import dates
from tickloom.functions.names import slug_text
from tickloom.operators import ohlcv, quality, series
from tickloom.operators.expectations import Expectation
from tickloom.sources import delimited, guarded, landing, order, sinks
from tickloom.sources.shared import stored


@dataclass(frozen=True)
class JobSummary:
    """What a job wrote."""

    rows: int
    csv_path: str | None
    parquet_path: str
    bucket: str | None = None
    key: str | None = None
    warnings: list[str] = field(default_factory=list)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [tuple(asdict(self).values())],
            "rows bigint, csv_path string, parquet_path string, bucket string, key string, warnings array<string>",
        )


@dataclass(frozen=True)
class TreatedSeries:
    """Treated rows (symbol, date as ISO text, close) and the findings about the input."""

    frame: DataFrame
    findings: DataFrame


def treat_table(
    table: DataFrame,
    mode: str = "strict",
    max_period_days: int = series.MAX_PERIOD_DAYS,
    min_rows: int = series.MIN_RECOMMENDED_ROWS,
    input_order: list[str] = order.ORDER,
    single_symbol: bool = False,
    store: bool = False,
) -> TreatedSeries:
    """Treated series of every symbol in a price table.

    ``single_symbol`` enforces the one-ticker-per-file contract: more than one ticker, or
    no valid row at all, is an error. With ``store``, and always for a single symbol, the
    rows per symbol and day are stored first, so that rows and findings read the source once.
    """
    layout = series.Layout.of(table, exact_first=mode == "lenient")
    parsed = series.parse_series(table, input_order, mode, layout)
    if single_symbol:
        quality.require_single_ticker(table, layout.symbol, count_missing=mode == "strict")
    days = series.days(parsed, input_order)
    if store or single_symbol:
        days = stored(days, "days")
    report = quality.report_of_days(days, min_rows, max_period_days)
    if single_symbol:  # a few findings of one series: found once, for the check here and for the caller
        found = [tuple(row) for row in report.collect()]
        report = table.sparkSession.createDataFrame(found, report.schema)
        quality.raise_on(report, ["no_valid_rows"])
        if days.isEmpty():
            raise series.SeriesError("the source is empty")
    recent = series.mark_trim(series.daily_closes(days), max_period_days).where("recent")
    return TreatedSeries(recent.select("symbol", dates.iso_text(F.col("date")).alias("date"), "close"), report)


def run_price_series_job(
    spark: SparkSession,
    input_path: str,
    source_name: str,
    treated_root: str,
    output_root: str,
    sep: str = "auto",
    bucket_root: str | None = None,
    key_prefix: str = "processed",
    mode: str = "strict",
    single_symbol: bool = True,
    single_file: bool = False,
) -> JobSummary:
    """Treat one file and write it as ``;`` CSV and as Parquet, and publish the Parquet
    under ``bucket_root`` (any Hadoop URI) when one is given.

    The source is treated once, for the Parquet; the CSV is written from that. With
    ``single_file`` each is one file, through one task. Findings of many symbols become a
    table as well.
    """
    name = slug_text(source_name)
    table = delimited.read_file(spark, input_path, sep)
    treated = treat_table(table, mode, single_symbol=single_symbol, store=True)
    columns = ["date", "close"] if single_symbol else ["symbol", "date", "close"]
    watch = Observation()
    result = treated.frame.select(*columns).orderBy(*columns[:-1])
    csv_path, parquet_path = f"{treated_root}/{name}.csv", f"{output_root}/{name}.parquet"
    counted = result.observe(watch, F.count(F.lit(1)).alias("rows"))
    if single_file:
        sinks.write_single(counted, parquet_path, "parquet")
    else:
        sinks.write_parquet(counted, parquet_path)
    rows = watch.get["rows"]
    written = spark.read.schema(result.schema).parquet(parquet_path).orderBy(*columns[:-1])
    if single_file:
        sinks.write_single(written, csv_path, "csv")
    else:
        sinks.write_csv(written, csv_path, ";")
    key = f"{key_prefix}/{name}.parquet" if bucket_root else None
    if bucket_root:
        sinks.publish(spark.read.parquet(parquet_path), bucket_root, key_prefix, source_name)
    noticed = treated.findings.where(F.col("severity") == "warning")
    if single_symbol:  # a few findings of one series
        warnings = [f"{row['symbol']}: {row['message']} ({row['observed']})" for row in noticed.orderBy("check").collect()]
    else:
        findings_path = sinks.write_parquet(treated.findings, f"{output_root}/{name}_findings.parquet")
        warnings = [f"findings of all symbols: {findings_path}"]
    return JobSummary(rows, csv_path, parquet_path, bucket_root, key, warnings)


def run_stock_job(
    spark: SparkSession, input_path: str, output_path: str, sep: str = "auto", buckets: int = 0
) -> JobSummary:
    """Curate an OHLCV file into Parquet partitioned by symbol, or by hash bucket of symbols."""
    raw = delimited.read_file(spark, input_path, sep)
    curated = ohlcv.curate(raw, order.ORDER, order.block())
    watch = Observation()
    sinks.write_by_symbol(curated.observe(watch, F.count(F.lit(1)).alias("rows")), output_path, buckets)
    return JobSummary(watch.get["rows"], None, output_path)


def quote_expectations() -> list[Expectation]:
    """What parsed quotes must keep: rows without day or close go to quarantine; an unknown symbol and a close of 0 or less are counted."""
    return [
        Expectation("day_known", F.col("date").isNotNull(), "divert"),
        Expectation("close_known", F.col("close").isNotNull(), "divert"),
        Expectation("symbol_known", F.col("symbol") != series.UNKNOWN_SYMBOL),
        Expectation("close_positive", F.col("close") > 0),
    ]


def write_quotes(
    table: DataFrame, path: str, mode: str = "strict", input_order: list[str] = order.ORDER, expectations: list[Expectation] | None = None,
) -> guarded.Written:
    """Parse a price table and write its rows under expectations (``quote_expectations`` if none are given), in one pass."""
    parsed = series.parse_series(table, input_order, mode)
    return guarded.write(parsed, path, quote_expectations() if expectations is None else expectations)


def upload_series(spark: SparkSession, path: str, source_name: str, landing_root: str, analysis_root: str, stamp: str) -> TreatedSeries:
    """A user's file: keep its bytes, require one ticker, treat leniently and write the
    display copy. Separator warnings join the findings."""
    landing.land_raw(spark, path, landing_root, source_name)
    full_path, separator = delimited.probed_file(spark, path)
    if separator is None:
        raise series.SeriesError("the source is empty")
    table = delimited.read_file(spark, path, separator)
    treated = treat_table(table, "lenient", single_symbol=True)
    seen = spark.createDataFrame([(full_path, separator)], "path string, separator string")
    display = treated.frame.select(F.to_date("date").alias("date"), "close").orderBy("date")
    sinks.write_display_csv(display, analysis_root, source_name, stamp)
    return TreatedSeries(treated.frame, treated.findings.unionByName(quality.separator_findings(seen)))
