"""Price tables derived from the given ones: a supplier is a symbol, a line item a quote.

Each view exists twice, as a DataFrame and as SQL for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.shared import scratch

# A line item's place in the input: order key, line number, part key and price, because
# the first two are not unique. As one number it is a fixed-width aggregation buffer, so
# first-and-last aggregates stay hash aggregates instead of sorting every map task.
ORDER = ["position"]
POSITION_SQL = """CAST(l_orderkey * 10 + l_linenumber AS HUGEINT) * 10000000000000000000
    + (l_partkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT))"""


def position() -> Column:
    line = F.expr("cast(l_orderkey * 10 + l_linenumber AS decimal(18,0)) * 10000000000000000000BD")
    return (line + F.expr("l_partkey * 100000000 + cast(round(l_extendedprice * 100) AS bigint)")).cast("decimal(38,0)")


def block() -> Column:
    """Coarse input position: one value spans at most 100,000 order keys."""
    return F.floor(F.col("position") / F.expr("1000000000000000000000000BD"))


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


RAW_QUOTES_SQL = f"""
lines AS (
  SELECT {POSITION_SQL} AS position, l_suppkey,
         CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS p,
         CAST(l_quantity AS BIGINT) AS q, l_orderkey * 7 + l_linenumber * 3 + l_partkey AS v
  FROM lineitem
),
raw_quotes AS (
  SELECT position,
    CASE v % 97 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'S' || CAST(l_suppkey AS VARCHAR) END AS symbol,
    CASE v % 12
      WHEN 5 THEN strftime(d, '%Y%m%d') WHEN 6 THEN strftime(d, '%d/%m/%Y')
      WHEN 7 THEN strftime(d, '%Y/%m/%d') WHEN 8 THEN ' ' || strftime(d, '%Y-%m-%d') || ' '
      WHEN 9 THEN strftime(d, '%Y%m')
      WHEN 10 THEN CASE v % 5 WHEN 0 THEN NULL WHEN 1 THEN 'not-a-date'
                   WHEN 2 THEN strftime(d, '%Y') || '-13-45' ELSE strftime(d, '%Y-%m-%d') || ' 10:30:00' END
      WHEN 11 THEN strftime(d, '%d.%m.%Y')
      ELSE strftime(d, '%Y-%m-%d') END AS trade_date,
    CASE WHEN v % 13 = 0 THEN NULL ELSE CAST(p AS VARCHAR) END AS open,
    CAST(CAST(p + 1.25 AS DECIMAL(18,2)) AS VARCHAR) AS high,
    CAST(CAST(p - 0.75 AS DECIMAL(18,2)) AS VARCHAR) AS low,
    CASE v % 11
      WHEN 5 THEN replace(CAST(p AS VARCHAR), '.', ',')
      WHEN 6 THEN CAST(CAST(floor(p) AS BIGINT) // 1000 AS VARCHAR) || '.' ||
                  lpad(CAST(CAST(floor(p) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || ',50'
      WHEN 7 THEN CAST(CAST(floor(p) AS BIGINT) // 1000 AS VARCHAR) || ',' ||
                  lpad(CAST(CAST(floor(p) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || '.50'
      WHEN 8 THEN ' ' || CAST(p AS VARCHAR) || ' '
      WHEN 9 THEN CASE v % 3 WHEN 0 THEN '1e3' WHEN 1 THEN '.5' END
      WHEN 10 THEN '+' || CAST(p AS VARCHAR)
      ELSE CAST(p AS VARCHAR) END AS close,
    CASE WHEN v % 17 = 0 THEN 'n/a' ELSE CAST(q AS VARCHAR) END AS volume
  FROM lines
)"""


def raw_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Messy text quotes, several per symbol and day, with the input order columns."""
    lines = read(spark, folder, "lineitem").select(
        position().alias("position"),
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("p"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.expr("l_orderkey * 7 + l_linenumber * 3 + l_partkey").alias("v"),
    )
    return lines.select(
        "position",
        F.expr("CASE v % 97 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE concat('S', l_suppkey) END").alias("symbol"),
        F.expr(
            """CASE v % 12
              WHEN 5 THEN date_format(d, 'yyyyMMdd') WHEN 6 THEN date_format(d, 'dd/MM/yyyy')
              WHEN 7 THEN date_format(d, 'yyyy/MM/dd') WHEN 8 THEN concat(' ', date_format(d, 'yyyy-MM-dd'), ' ')
              WHEN 9 THEN date_format(d, 'yyyyMM')
              WHEN 10 THEN CASE v % 5 WHEN 0 THEN NULL WHEN 1 THEN 'not-a-date'
                WHEN 2 THEN concat(date_format(d, 'yyyy'), '-13-45')
                ELSE concat(date_format(d, 'yyyy-MM-dd'), ' 10:30:00') END
              WHEN 11 THEN date_format(d, 'dd.MM.yyyy')
              ELSE date_format(d, 'yyyy-MM-dd') END"""
        ).alias("trade_date"),
        F.expr("CASE WHEN v % 13 = 0 THEN NULL ELSE cast(p AS string) END").alias("open"),
        F.expr("cast(cast(p + 1.25BD AS decimal(18,2)) AS string)").alias("high"),
        F.expr("cast(cast(p - 0.75BD AS decimal(18,2)) AS string)").alias("low"),
        F.expr(
            """CASE v % 11
              WHEN 5 THEN replace(cast(p AS string), '.', ',')
              WHEN 6 THEN concat(floor(p) div 1000, '.', lpad(cast(floor(p) % 1000 AS string), 3, '0'), ',50')
              WHEN 7 THEN concat(floor(p) div 1000, ',', lpad(cast(floor(p) % 1000 AS string), 3, '0'), '.50')
              WHEN 8 THEN concat(' ', p, ' ')
              WHEN 9 THEN CASE v % 3 WHEN 0 THEN '1e3' WHEN 1 THEN '.5' END
              WHEN 10 THEN concat('+', p)
              ELSE cast(p AS string) END"""
        ).alias("close"),
        F.expr("CASE WHEN v % 17 = 0 THEN 'n/a' ELSE cast(q AS string) END").alias("volume"),
    )


BARS_SQL = """
bars AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
    arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS open,
    max(l_extendedprice) AS high, min(l_extendedprice) AS low,
    arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS close,
    CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1, 2
)"""


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """One open/high/low/close/volume bar per symbol and day."""
    place = position()
    price = F.col("l_extendedprice")
    return (
        read(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.min_by(price, place).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, place).alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .select(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), "date", "open", "high", "low", "close", "volume")
    )


FIXED_LINES_SQL = BARS_SQL + """,
fixed_lines AS (
  SELECT rpad(
    CASE WHEN volume % 10 = 0 THEN '99' ELSE '01' END || strftime(date, '%Y%m%d') || rpad(symbol, 14, ' ') ||
    repeat(' ', 32) || lpad(CAST(CAST(round(open * 100) AS BIGINT) AS VARCHAR), 13, '0') ||
    lpad(CAST(CAST(round(high * 100) AS BIGINT) AS VARCHAR), 13, '0') ||
    CASE WHEN volume % 7 = 0 THEN repeat(' ', 13) ELSE lpad(CAST(CAST(round(low * 100) AS BIGINT) AS VARCHAR), 13, '0') END ||
    repeat('0', 26) || lpad(CAST(CAST(round(close * 100) AS BIGINT) AS VARCHAR), 13, '0') ||
    lpad(CAST(volume AS VARCHAR), 13, '0'),
    CASE WHEN volume % 11 = 0 THEN 140 ELSE 160 END, ' ') AS value
  FROM bars
)"""


def fixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The bars as fixed-width quote records; some lines are too short or of another type."""

    def cents(name: str) -> Column:
        return F.lpad(F.round(F.col(name) * 100).cast("bigint").cast("string"), 13, "0")

    blank = F.lit(" " * 13)
    line = F.concat(
        F.when(F.col("volume") % 10 == 0, "99").otherwise("01"),
        F.date_format("date", "yyyyMMdd"),
        F.rpad("symbol", 14, " "),
        F.lit(" " * 32),
        cents("open"),
        cents("high"),
        F.when(F.col("volume") % 7 == 0, blank).otherwise(cents("low")),
        F.lit("0" * 26),
        cents("close"),
        F.lpad(F.col("volume").cast("string"), 13, "0"),
    )
    width = F.when(F.col("volume") % 11 == 0, 140).otherwise(160)
    return bars(spark, folder).select(F.rpad(line, width, F.lit(" ")).alias("value"))


PRICE_LINES_SQL = """
sep_lines AS (
  SELECT 'file-' || CAST(l_suppkey AS VARCHAR) AS path, l_orderkey + 1 AS place,
    CASE WHEN l_suppkey % 3 = 0 THEN ',' ELSE ';' END AS separator,
    'S' || CAST(l_suppkey AS VARCHAR) AS symbol, strftime(l_shipdate, '%Y-%m-%d') AS date,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity
  FROM lineitem
),
price_lines AS (
  SELECT path, place, separator,
    CASE WHEN separator = ',' THEN symbol || ',' || date || ',' || price || ',' || quantity
         ELSE symbol || ';' || date || ';' || replace(price, '.', ',') END AS text FROM sep_lines
  UNION ALL
  SELECT DISTINCT path, 0, separator,
    CASE WHEN separator = ',' THEN 'symbol,date,close,volume' ELSE 'symbol;date;close' END FROM sep_lines
)"""


def price_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of one delimited file per supplier, in two layouts, with a header at place 0."""
    key = F.col("l_suppkey")
    items = read(spark, folder, "lineitem").select(
        F.concat(F.lit("file-"), key).alias("path"),
        (F.col("l_orderkey") + 1).alias("place"),
        F.when(key % 3 == 0, ",").otherwise(";").alias("separator"),
        F.concat(F.lit("S"), key).alias("symbol"),
        F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd").alias("date"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.col("l_quantity").cast("bigint").cast("string").alias("quantity"),
    )
    comma = F.col("separator") == ","
    body = items.select(
        "path", "place", "separator",
        F.when(comma, F.concat_ws(",", "symbol", "date", "price", "quantity"))
        .otherwise(F.concat_ws(";", "symbol", "date", F.translate("price", ".", ","))).alias("text"),
    )
    headers = items.select("path", F.lit(0).cast("bigint").alias("place"), "separator").distinct().withColumn(
        "text", F.when(comma, "symbol,date,close,volume").otherwise("symbol;date;close")
    )
    return body.unionByName(headers)


# Text columns of several kinds, for type inference.
KINDS_SQL = """
kinds AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS whole, CASE WHEN l_linenumber = 7 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) WHEN l_linenumber = 6 THEN '1e3'
      ELSE ' ' || CAST(l_partkey AS VARCHAR) END AS number,
    CASE WHEN l_linenumber = 1 THEN '' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day,
    CASE WHEN l_linenumber = 2 THEN strftime(l_shipdate, '%Y-%m-%d') || ' 10:30:00' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS moment,
    CASE WHEN l_linenumber = 3 THEN '1994-02-30' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS bad_day,
    CASE WHEN l_linenumber = 4 THEN '7' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS mixed,
    CASE WHEN l_linenumber = 5 THEN '99999999999999999999' ELSE '1' END AS large, CASE WHEN l_linenumber = 1 THEN '  ' END AS nothing, l_returnflag AS name
  FROM lineitem
)"""
KINDS = ("whole", "number", "day", "moment", "bad_day", "mixed", "large", "nothing", "name")


def kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as text: whole and other numbers, days, moments, days that are none, and mixtures."""
    day, place = F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd"), F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return read(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("whole"),
        F.when(place == 7, price).when(place == 6, "1e3").otherwise(F.concat(F.lit(" "), "l_partkey")).alias("number"),
        F.when(place == 1, "").otherwise(day).alias("day"), F.when(place == 2, F.concat(day, F.lit(" 10:30:00"))).otherwise(day).alias("moment"),
        F.when(place == 3, "1994-02-30").otherwise(day).alias("bad_day"), F.when(place == 4, "7").otherwise(day).alias("mixed"),
        F.when(place == 5, "9" * 20).otherwise("1").alias("large"), F.when(place == 1, "  ").alias("nothing"), F.col("l_returnflag").alias("name"),
    )


# Files of four layouts: separators, column orders and decimal marks differ, some fields are quoted,
# some bytes are no UTF-8, and columns come and go.
LAYOUT_ROWS_SQL = """
layout_rows AS (
  SELECT 'file-' || CAST(l_suppkey AS VARCHAR) AS path, l_suppkey % 4 AS kind, 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
    strftime(l_shipdate, '%Y-%m-%d') AS date, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS close,
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS volume FROM lineitem
)"""
LAYOUT_HEADERS = ("symbol;date;close;volume", "date,symbol,close", '"close";"symbol";"note 2";"date"', "volume,date,Symbol,close,flag3")


def layout_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(path, place, text): the lines of one file per supplier, headers at place 0."""
    key = F.col("l_suppkey")
    rows = read(spark, folder, "lineitem").select(
        F.concat(F.lit("file-"), key).alias("path"), (key % 4).cast("int").alias("kind"), F.concat(F.lit("S"), key).alias("symbol"),
        F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd").alias("date"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("close"), F.col("l_quantity").cast("bigint").cast("string").alias("volume"),
    )
    broken = F.concat(F.lit("caf"), F.unhex(F.lit("E9")).cast("string"))
    text = (
        F.when(F.col("kind") == 0, F.concat_ws(";", "symbol", "date", F.translate("close", ".", ","), "volume"))
        .when(F.col("kind") == 1, F.concat_ws(",", "date", "symbol", "close"))
        .when(F.col("kind") == 2, F.concat_ws(";", "close", "symbol", F.lit('"a;b"'), "date"))
        .otherwise(F.concat_ws(",", "volume", "date", "symbol", "close", broken))
    )
    body = rows.select("path", F.lit(1).alias("place"), text.alias("text"))
    header = F.get(F.array(*map(F.lit, LAYOUT_HEADERS)), F.col("kind"))
    return body.unionByName(rows.select("path", F.lit(0).alias("place"), header.alias("text")).distinct())


def as_files(lines: DataFrame, name: str, line_end: str = "\n") -> str:
    """(path, place, text) as one text file per path, in folders ``path=...``; lines of one place in order of their text."""
    target = scratch(lines.sparkSession, name)
    placed = lines.repartition("path").sortWithinPartitions("path", "place", "text").select("path", "text")
    # Tasks move their own files to the new folder; by the first algorithm the driver moves them one by one.
    moved = placed.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    moved.option("lineSep", line_end).partitionBy("path").text(target)
    return target


RUNS_SQL = """
runs AS (
  SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_key, 'U' || CAST(user_id AS VARCHAR) AS symbol,
    'a-U' || CAST(user_id AS VARCHAR) AS action_key, CAST(event_id AS INTEGER) AS run_number, ts AS updated_at,
    event_type AS source_name, event_id, event_type, value FROM events
),
valid AS (
  SELECT * FROM runs WHERE event_type <> 'error' AND value > 2.0 AND event_id % 5 <> 0
)"""


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events as finished runs: the user is the ticker."""
    return read(spark, folder, "events").select(
        F.concat(F.lit("run-"), "event_id").alias("run_key"),
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        F.concat(F.lit("a-U"), "user_id").alias("action_key"),
        F.col("event_id").cast("int").alias("run_number"),
        F.col("ts").alias("updated_at"),
        F.col("event_type").alias("source_name"),
    )


def artifacts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Runs for which each required artifact exists."""
    events = read(spark, folder, "events").withColumn("run_key", F.concat(F.lit("run-"), "event_id"))
    return {
        "training_metrics": events.where(F.col("event_type") != "error"),
        "test_predictions": events.where(F.col("value") > 2.0),
        "future_predictions": events.where(F.col("event_id") % 5 != 0),
    }
