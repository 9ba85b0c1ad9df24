"""SQL for the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

from tickloom.workload.tables import (
    BARS_SQL, FIXED_LINES_SQL, KINDS, KINDS_SQL, LAYOUT_HEADERS, LAYOUT_ROWS_SQL, PRICE_LINES_SQL, RAW_QUOTES_SQL, RUNS_SQL,
)


# Text rules

_OHLCV_DAY = """CASE
  WHEN regexp_full_match(td, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(td AS DATE)
  WHEN regexp_full_match(td, '[0-9]{6}') THEN TRY_CAST(td[1:4] || '-' || td[5:6] || '-01' AS DATE)
  ELSE DATE '1970-01-01' END"""

_STRICT_DAY = """CASE
  WHEN regexp_full_match(trim(trade_date), '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN try_strptime(trim(trade_date), '%Y-%m-%d')
  WHEN regexp_full_match(trim(trade_date), '[0-9]{8}') THEN try_strptime(trim(trade_date), '%Y%m%d')
  WHEN regexp_full_match(trim(trade_date), '[0-9]{2}/[0-9]{2}/[0-9]{4}') THEN try_strptime(trim(trade_date), '%d/%m/%Y')
  WHEN regexp_full_match(trim(trade_date), '[0-9]{4}/[0-9]{2}/[0-9]{2}') THEN try_strptime(trim(trade_date), '%Y/%m/%d')
END::DATE"""

_LENIENT_DAY = """coalesce(
  try_strptime(trim(trade_date), '%Y-%m-%d'), try_strptime(trim(trade_date), '%Y-%m-%d %H:%M:%S'),
  CASE WHEN length(trim(trade_date)) = 8 THEN try_strptime(trim(trade_date), '%Y%m%d') END,
  try_strptime(trim(trade_date), '%d/%m/%Y'), try_strptime(trim(trade_date), '%d.%m.%Y'),
  try_strptime(trim(trade_date), '%Y/%m/%d'))::DATE"""

_CLEAN = "CASE WHEN contains(close, ',') THEN replace(replace(trim(close), '.', ''), ',', '.') ELSE trim(close) END"
_STRICT_CLOSE = f"CASE WHEN regexp_full_match({_CLEAN}, '[+-]?[0-9]+([.][0-9]+)?') THEN TRY_CAST({_CLEAN} AS DOUBLE) END"
_MONTH_FIRST_DAY = """coalesce(
  CASE WHEN regexp_full_match(trim(trade_date), '\\d{2}[/.]\\d{2}[/.]\\d{4}') THEN coalesce(
      TRY_CAST(substr(trim(trade_date), 7, 4) || '-' || substr(trim(trade_date), 1, 2) || '-' || substr(trim(trade_date), 4, 2) AS DATE),
      TRY_CAST(substr(trim(trade_date), 7, 4) || '-' || substr(trim(trade_date), 4, 2) || '-' || substr(trim(trade_date), 1, 2) AS DATE)) END,
  CASE WHEN regexp_full_match(trim(trade_date), '\\d{8}') THEN
      TRY_CAST(substr(trim(trade_date), 1, 4) || '-' || substr(trim(trade_date), 5, 2) || '-' || substr(trim(trade_date), 7, 2) AS DATE) END,
  CASE WHEN regexp_matches(trim(trade_date), '^\\d{4}[-/]\\d{2}[-/]\\d{2}( |$)') THEN TRY_CAST(replace(substr(trim(trade_date), 1, 10), '/', '-') AS DATE) END)"""
_NUMBER = "CASE WHEN regexp_matches(trim({x}), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') THEN TRY_CAST(trim({x}) AS DOUBLE) END"
_LENIENT_CLOSE = f"round(TRY_CAST({_CLEAN} AS DOUBLE), 6)"
_SYMBOL = "coalesce(nullif(trim(symbol), ''), 'UNKNOWN')"


def _parsed(day: str, close: str) -> str:
    return f"""WITH {RAW_QUOTES_SQL},
parsed AS (SELECT {_SYMBOL} AS symbol, {day} AS date, {close} AS close,
  position FROM raw_quotes)"""


def _treated(day: str, close: str, shown: str) -> str:
    return f"""{_parsed(day, close)},
daily AS (SELECT symbol, date, arg_max(close, position) AS close FROM parsed
  WHERE date IS NOT NULL AND close IS NOT NULL GROUP BY ALL)
SELECT symbol, strftime(date, '{shown}') AS date, close FROM daily d
WHERE date >= (SELECT max(date) FROM daily x WHERE x.symbol = d.symbol) - INTERVAL 365 DAY"""


_CURATED = f"""{RAW_QUOTES_SQL},
typed AS (
  SELECT coalesce(symbol, 'UNKNOWN') AS symbol, coalesce(trade_date, '1970-01-01') AS td, TRY_CAST(open AS DOUBLE) AS o,
    TRY_CAST(high AS DOUBLE) AS h, TRY_CAST(low AS DOUBLE) AS l, TRY_CAST(close AS DOUBLE) AS c,
    TRY_CAST(volume AS BIGINT) AS v, position FROM raw_quotes
),
dated AS (SELECT *, {_OHLCV_DAY} AS day FROM typed),
linked AS (
  SELECT *, last_value(c IGNORE NULLS) OVER (PARTITION BY symbol
    ORDER BY day NULLS FIRST, position
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_close FROM dated
),
curated AS (
  SELECT symbol, td AS trade_date, coalesce(o, 0) AS open, coalesce(h, 0) AS high, coalesce(l, 0) AS low,
    coalesce(c, 0) AS close, coalesce(v, 0) AS volume, strftime(day, '%Y-%m-%d') AS trade_date_fmt, prev_close,
    coalesce(CASE WHEN prev_close <> 0 THEN (c - prev_close) / prev_close * 100 END, 0) AS daily_pct_change FROM linked
)"""

_TRAINING_DAY = """CASE
  WHEN regexp_full_match(trade_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(trade_date AS DATE)
  WHEN regexp_full_match(trade_date, '[0-9]{6}') THEN try_strptime(trade_date || '01', '%Y%m%d')::DATE
  WHEN regexp_full_match(trade_date, '[0-9]{8}') THEN try_strptime(trade_date, '%Y%m%d')::DATE END"""

_PADDED_DAY = """coalesce(
  CASE WHEN length(trim(trade_date)) = 6 THEN try_strptime(trim(trade_date) || '01', '%Y%m%d') END,
  try_strptime(trim(trade_date), '%Y-%m-%d'), try_strptime(trim(trade_date), '%Y-%m-%d %H:%M:%S'),
  CASE WHEN length(trim(trade_date)) = 8 THEN try_strptime(trim(trade_date), '%Y%m%d') END,
  try_strptime(trim(trade_date), '%Y/%m/%d'))::DATE"""

_RANKED = """ranked AS (SELECT symbol, count(*) AS "count" FROM bars GROUP BY 1 ORDER BY 2 DESC, 1)"""

# Features

_SPLIT_SIZE = "greatest(1, least(CAST(floor({n} * (1.0::DOUBLE - 0.2::DOUBLE)) AS BIGINT), {n} - 1))"


def _features(source: str = "bars") -> str:
    return f"""
placed AS (
  SELECT symbol, date, close, ln(1 + close) AS log_close, row_number() OVER w AS rn, count(*) OVER p AS n,
    min(date) OVER p AS first_date, max(date) OVER p AS last_date
  FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY date), p AS (PARTITION BY symbol)
),
indexed AS (SELECT *, CAST(date_diff('day', first_date, date) AS DOUBLE) AS day_index FROM placed),
lagged AS (
  SELECT *, greatest(max(CASE WHEN rn <= {_SPLIT_SIZE.format(n="n")} THEN day_index END) OVER (PARTITION BY symbol), 1.0) AS scale,
    lag(log_close, 1) OVER w AS lag_1, lag(log_close, 2) OVER w AS lag_2, lag(log_close, 3) OVER w AS lag_3,
    lag(log_close, 6) OVER w AS lag_6, count(log_close) OVER r AS known,
    avg(log_close) OVER r AS mean_7, stddev_samp(log_close) OVER r AS std_7
  FROM indexed WINDOW w AS (PARTITION BY symbol ORDER BY date),
    r AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
),
built AS (
  SELECT *, day_index / scale AS t, (day_index / scale) * (day_index / scale) AS t2, ln(1 + day_index / scale) AS log_t,
    CASE WHEN known >= 2 THEN mean_7 END AS rolling_mean_7, CASE WHEN known >= 2 THEN std_7 END AS rolling_std_7,
    lag_1 - lag_6 AS momentum_5 FROM lagged
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS place, count(*) OVER (PARTITION BY symbol) AS feature_rows
  FROM built WHERE momentum_5 IS NOT NULL AND rolling_mean_7 IS NOT NULL AND rolling_std_7 IS NOT NULL AND lag_3 IS NOT NULL
),
features AS (
  SELECT *, CASE WHEN place <= {_SPLIT_SIZE.format(n="feature_rows")} THEN 'train' ELSE 'test' END AS part FROM numbered
)"""


_TEST_ROWS = f"""{BARS_SQL}, {_features()},
baseline AS (
  SELECT symbol, date, close, part, exp(rolling_mean_7) - 1 AS predicted,
    lag(close) OVER (PARTITION BY symbol ORDER BY date) AS naive
  FROM features WHERE n >= 10 AND feature_rows >= 14
),
test AS (SELECT * FROM baseline WHERE part = 'test')"""


def _errors(prefix: str, predicted: str, places: str = ", 6") -> str:
    return f"""round(sqrt(avg((close - {predicted}) * (close - {predicted}))){places}) AS {prefix}rmse,
    round(avg(abs(close - {predicted})){places}) AS {prefix}mae,
    round(CASE WHEN var_pop(close) <= 0 THEN 1.0
      ELSE 1.0 - avg((close - {predicted}) * (close - {predicted})) / var_pop(close) END{places}) AS {prefix}r2"""


_FOLDS = f"""{_TEST_ROWS},
sized AS (
  SELECT *, count(*) OVER (PARTITION BY symbol) AS n, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM test
),
folded AS (
  SELECT *, CAST(least((rn - 1) // greatest(1, n // greatest(1, least(3, n))), greatest(1, least(3, n)) - 1) + 1 AS INTEGER) AS fold
  FROM sized
),
folds AS (
  SELECT symbol, fold, min(date) AS start_date, max(date) AS end_date, count(*) AS rows,
    {_errors("model_", "predicted", ", 10")}, {_errors("naive_", "naive", ", 10")}
  FROM folded GROUP BY 1, 2
)"""

_NAMES = ("t", "t2", "log_t", "lag_1", "lag_2", "lag_3", "rolling_mean_7", "rolling_std_7", "momentum_5", "log_close")
_LEVELS = ("lag_1", "lag_2", "lag_3", "rolling_mean_7", "log_close")


def _shifted(name: str) -> str:
    return f"({name} - center)" if name in _LEVELS else name


_PROFILE_NUMBER = """SELECT '{name}' AS "column", count({value}) AS count, CAST(NULL AS BIGINT) AS "unique",
  CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, round(avg({value}), 6) AS mean, {std} AS std,
  round(min({value}), 6) AS min, round(quantile_cont({value}, 0.25), 6) AS q25, round(quantile_cont({value}, 0.5), 6) AS q50,
  round(quantile_cont({value}, 0.75), 6) AS q75, round(max({value}), 6) AS max FROM bars"""


def _profile_part(name: str) -> str:
    if name == "date":
        value, std = "CAST(date_diff('day', DATE '1970-01-01', date) AS DOUBLE)", "CAST(NULL AS DOUBLE)"
    else:
        value = f"CAST({name} AS DOUBLE)"
        std = f"round(stddev_samp({value}), 6)"
    return _PROFILE_NUMBER.format(name=name, value=value, std=std)


_MEASURES = ("open", "high", "low", "close", "volume", "daily_pct_change")
_CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(CASE WHEN isnan(c) THEN NULL ELSE c END, 6) AS correlation FROM "
    f"(SELECT corr({x}, {y}) AS c FROM varied)"
    for x in (*_MEASURES, "unit")
    for y in (*_MEASURES, "unit")
)

_FINDINGS = """
SELECT symbol, 'dropped_rows' AS "check", 'info' AS severity, dropped AS observed, 'rows without a usable date or close' AS message
  FROM totals WHERE dropped > 0
UNION ALL SELECT symbol, 'no_valid_rows', 'error', days, 'no valid row after converting date and close' FROM totals WHERE days = 0
UNION ALL SELECT symbol, 'small_series', 'warning', days, 'few valid rows; metrics may be unstable' FROM totals WHERE days BETWEEN 1 AND 29
UNION ALL SELECT symbol, 'trimmed', 'warning', date_diff('day', first, last), 'series limited to the last 365 days' FROM totals
  WHERE first < last - INTERVAL 365 DAY"""

_BETA = (0.02, -0.01, 0.03, 0.4, 0.2, 0.1, 0.2, -0.05, 0.1)
_STEP_INPUTS = (
    "x.t", "x.t * x.t", "ln(1 + x.t)", "h[7]", "h[6]", "h[5]", "list_avg(h)", "list_stddev_samp(h)", "h[7] - h[2]",
)
_STEP = " + ".join(["1.0::DOUBLE", *[f"({b}::DOUBLE) * ({x})" for b, x in zip(_BETA, _STEP_INPUTS)]])

# Ridge by Gauss-Jordan elimination on the penalised correlation matrix, one step per feature

_INPUTS = _NAMES[:9]


def _entry(i: int, j: int) -> str:
    a, b = min(i, j), max(i, j)
    ratio = f"c_{a}_{b} / (s_{a} * s_{b}) * (cnt - 1) / cnt"
    return f"{ratio} + penalty / s_9" if i == j else ratio


_SYSTEM = "[" + ", ".join("[" + ", ".join([_entry(i, j) for j in range(9)] + [_entry(i, 9)]) + "]" for i in range(9)) + "]"
_PENALTIES = "(VALUES (0.001::DOUBLE), (0.01::DOUBLE), (0.1::DOUBLE)) p(penalty)"


def _rule(beta: str, intercept: str, inputs: tuple[str, ...] = _INPUTS) -> str:
    return " + ".join([intercept, *[f"{beta}[{i + 1}] * {name}" for i, name in enumerate(inputs)]])


_SQUARED = "(log_close - p) * (log_close - p)"
_FITS = f"""{BARS_SQL}, {_features()},
usable AS (SELECT * FROM features WHERE n >= 10 AND feature_rows >= 14),
sets AS (SELECT 'train' AS fit, * FROM usable WHERE part = 'train' UNION ALL SELECT 'full' AS fit, * FROM usable),
stats AS (
  SELECT symbol, fit, CAST(count(*) AS DOUBLE) AS cnt, {", ".join(f"avg({x}) AS m_{i}" for i, x in enumerate(_NAMES))},
    {", ".join(f"stddev_samp({x}) AS s_{i}" for i, x in enumerate(_NAMES))},
    {", ".join(f"covar_samp({_NAMES[i]}, {_NAMES[j]}) AS c_{i}_{j}" for i in range(10) for j in range(i, 10))}
  FROM sets GROUP BY 1, 2
),
elimination AS (
  SELECT symbol, fit, penalty, 1 AS k, {_SYSTEM} AS m FROM stats, {_PENALTIES}
  UNION ALL
  SELECT symbol, fit, penalty, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
    THEN list_transform(r, lambda x: x / r[k])
    ELSE list_transform(r, lambda x, j: x - r[k] / m[k][k] * m[k][j]) END)
  FROM elimination WHERE k <= 9
),
solved AS (
  SELECT e.symbol, e.fit, e.penalty, [{", ".join(f"m[{i + 1}][10] * s_9 / s_{i}" for i in range(9))}] AS beta, {", ".join(f"m_{i}" for i in range(10))}
  FROM elimination e JOIN stats USING (symbol, fit) WHERE k = 10
),
fits AS (SELECT symbol, fit, penalty, beta, m_9 - ({_rule("beta", "0", tuple(f"m_{i}" for i in range(9)))}) AS intercept FROM solved),
scored AS (
  SELECT u.*, penalty, {_rule("beta", "intercept")} AS p, lag(close) OVER (PARTITION BY symbol, penalty ORDER BY date) AS naive
  FROM usable u JOIN (SELECT * FROM fits WHERE fit = 'train') USING (symbol)
),
attempts AS (
  SELECT symbol, penalty AS reg_param,
    1 - avg({_SQUARED}) FILTER (part = 'train') / var_pop(log_close) FILTER (part = 'train') AS train_r2,
    1 - avg({_SQUARED}) FILTER (part = 'test') / var_pop(log_close) FILTER (part = 'test') AS r2,
    sqrt(avg({_SQUARED}) FILTER (part = 'test')) AS rmse, avg(abs(log_close - p)) FILTER (part = 'test') AS mae
  FROM scored GROUP BY 1, 2
),
search AS (
  SELECT *, row_number() OVER (PARTITION BY symbol
    ORDER BY -r2 + 0.15 * greatest(0.0, train_r2 - r2) + 0.005 * rmse, reg_param) = 1 AS chosen FROM attempts
)"""

_FORECAST = f"""{_FITS},
best AS (SELECT symbol, reg_param FROM search WHERE chosen),
raw_predictions AS (
  SELECT s.symbol, s.date, s.close, s.part, s.naive, exp(p) - 1 AS predicted, penalty AS reg_param, last_date
  FROM scored s JOIN best b ON s.symbol = b.symbol AND s.penalty = b.reg_param
),
centres AS (SELECT symbol, part, avg(close) AS m FROM raw_predictions GROUP BY 1, 2),
spreads AS (
  SELECT symbol, part, any_value(m) AS m, sum((predicted - m) * (close - m)) AS a, sum((predicted - m) * (predicted - m)) AS b,
    sum((close - m) * (close - m)) AS s, sum((close - predicted) * (close - predicted)) AS e
  FROM raw_predictions JOIN centres USING (symbol, part) GROUP BY 1, 2
),
shrinks AS (
  SELECT symbol, part, m, least(1 - e / s, 0.8) AS calibrated_r2,
    CASE WHEN 1 - e / s > 0.8 THEN (a - sqrt(greatest(0.0, a * a - 0.8 * s * b))) / b ELSE 1.0 END AS f FROM spreads
),
predictions AS (
  SELECT symbol, date, close, part, naive, f * predicted + (1 - f) * m AS predicted, reg_param, last_date, calibrated_r2
  FROM raw_predictions JOIN shrinks USING (symbol, part)
),
past AS (SELECT symbol, date, close, predicted, naive FROM predictions WHERE part = 'test'),
sized AS (SELECT *, count(*) OVER (PARTITION BY symbol) AS n, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM past),
folded AS (
  SELECT *, CAST(least((rn - 1) // greatest(1, n // greatest(1, least(3, n))), greatest(1, least(3, n)) - 1) + 1 AS INTEGER) AS fold FROM sized
),
folds AS (
  SELECT symbol, fold, min(date) AS start_date, max(date) AS end_date, count(*) AS rows,
    {_errors("model_", "predicted", ", 10")}, {_errors("naive_", "naive", ", 10")} FROM folded GROUP BY 1, 2
),
starts AS (
  SELECT u.symbol, list(log_close ORDER BY place) FILTER (WHERE place > feature_rows - 7) AS h, max(scale) AS scale, max(last_date) AS last_date,
    CAST(date_diff('day', max(first_date), max(last_date)) AS DOUBLE) AS last_index, any_value(beta) AS beta, any_value(intercept) AS intercept
  FROM usable u JOIN best USING (symbol) JOIN fits f ON f.symbol = u.symbol AND f.fit = 'full' AND f.penalty = best.reg_param GROUP BY 1
),
future_steps AS (
  SELECT symbol, h, scale, last_date, last_index, beta, intercept, 0 AS i, CAST(NULL AS DOUBLE) AS p FROM starts
  UNION ALL
  SELECT symbol, list_append(h[2:7], p), scale, last_date, last_index, beta, intercept, i, p FROM (
    SELECT s.symbol, s.h, s.scale, s.last_date, s.last_index, s.beta, s.intercept, s.i + 1 AS i,
      {_rule("s.beta", "s.intercept", tuple(f"({x})" for x in _STEP_INPUTS))} AS p
    FROM (SELECT *, (last_index + i + 1) / scale AS t FROM future_steps WHERE i < 31) s, LATERAL (SELECT s.t AS t) x
  )
),
future AS (SELECT symbol, CAST(last_date + i AS DATE) AS date, exp(p) - 1 AS predicted FROM future_steps WHERE i > 0)"""

_LINE = "SELECT symbol, '{series}' AS series, '{label}' AS label, date, round({value}, 3) AS value FROM {source}"

_FIXED = "coalesce(CAST(CAST(round(CAST({name} AS DOUBLE), 8) AS DECIMAL(38,8)) AS VARCHAR), '-')"
_DIGEST = "sha256(concat_ws('|', strftime(date, '%Y-%m-%d'), " + ", ".join(
    _FIXED.format(name=name) for name in ("close", "high", "low", "volume")
) + "))"

# The rows of the next-close models in their order, and the linear model by elimination: means, then the
# centred moments relative to the inputs' own spread, one pivot after the other, back substitution.
_INPUT_NAMES = ("open", "high", "low", "volume", "prev_close")


def _split_parts(rows: str, order: str) -> str:
    size = "CAST(floor({n} * (1.0::DOUBLE - 0.2)) AS BIGINT)"
    cut = "greatest(1, least(" + size + ", {n} - 1))"
    return f"""counted AS (SELECT *, row_number() OVER (ORDER BY {order}) AS rank, count(*) OVER () AS n FROM {rows}),
cuts AS (SELECT *, {cut.format(n="n")} AS first_cut FROM counted),
parts AS (SELECT *, CASE WHEN rank <= {cut.format(n="first_cut")} THEN 'fit' WHEN rank <= first_cut THEN 'validation' ELSE 'held_out' END AS part FROM cuts)"""


def _eliminated() -> str:
    size = len(_INPUT_NAMES)
    names = (*_INPUT_NAMES, "next_close")
    means = ", ".join(f"avg({x}) AS mean_{x}, stddev_pop({x}) AS dev_{x}" for x in names)
    moment = "avg(({x} - mean_{x}) / dev_{x} * (({y} - mean_{y}) / dev_{y}))"
    start = ", ".join(moment.format(x=names[i], y=names[j]) + f" AS a{i}_{j}" for i in range(size) for j in range(size + 1))
    steps, last = [], "moments"
    for k in range(size):
        cells = ", ".join(
            f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" if i > k else f"a{i}_{j}" for i in range(size) for j in range(size + 1)
        )
        steps.append(f"pivot{k} AS (SELECT {cells} FROM {last})")
        last = f"pivot{k}"
    for i in reversed(range(size)):
        known = "".join(f" - a{i}_{j} * w{j}" for j in range(i + 1, size))
        steps.append(f"back{i} AS (SELECT *, (a{i}_{size}{known}) / a{i}_{i} AS w{i} FROM {last})")
        last = f"back{i}"
    betas = ", ".join(f"w{i} * dev_next_close / dev_{x} AS beta_{x}" for i, x in enumerate(_INPUT_NAMES))
    line = " + ".join(f"beta_{x} * mean_{x}" for x in _INPUT_NAMES)
    return f"""scales AS (SELECT {means} FROM parts WHERE part = 'fit'),
moments AS (SELECT {start} FROM parts, scales WHERE part = 'fit'),
{", ".join(steps)},
slopes AS (SELECT {betas}, {", ".join(f"mean_{x}" for x in names)} FROM {last}, scales),
model AS (SELECT *, mean_next_close - ({line}) AS beta_intercept FROM slopes)"""


_LAYOUT_LINES = f"""{LAYOUT_ROWS_SQL},
layout_lines AS (
  SELECT path, 1 AS place, CASE kind WHEN 0 THEN symbol || ';' || date || ';' || replace(close, '.', ',') || ';' || volume
    WHEN 1 THEN date || ',' || symbol || ',' || close WHEN 2 THEN close || ';' || symbol || ';"a;b";' || date
    ELSE volume || ',' || date || ',' || symbol || ',' || close || ',caf' || chr(233) END AS text FROM layout_rows
  UNION ALL SELECT DISTINCT path, 0, CASE kind {" ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(LAYOUT_HEADERS))} END FROM layout_rows
)"""
_PREV_NEXT = f"""{RAW_QUOTES_SQL},
typed AS (
  SELECT symbol, {_TRAINING_DAY} AS trade_date_fmt, TRY_CAST(open AS DOUBLE) AS open, TRY_CAST(high AS DOUBLE) AS high,
    TRY_CAST(low AS DOUBLE) AS low, TRY_CAST(close AS DOUBLE) AS close, TRY_CAST(volume AS DOUBLE) AS volume,
    position FROM raw_quotes
),
linked AS (
  SELECT *, lag(close) OVER w AS prev_close, lead(close) OVER w AS next_close FROM typed
  WINDOW w AS (PARTITION BY symbol ORDER BY trade_date_fmt NULLS FIRST, position)
),
complete AS (
  SELECT symbol, trade_date_fmt, close, prev_close, next_close, volume FROM linked
  WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND volume IS NOT NULL AND prev_close IS NOT NULL
    AND next_close IS NOT NULL
)"""
_TOTAL_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ("trade_date_fmt", "symbol", "close", "prev_close", "next_close", "volume"))
_NEXT_CLOSE = f"""{BARS_SQL},
next_close_rows AS (
  SELECT symbol, date AS trade_date_fmt, open, high, low, CAST(volume AS DOUBLE) AS volume, lag(close) OVER w AS prev_close, lead(close) OVER w AS next_close
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)
),
usable_rows AS (SELECT * FROM next_close_rows WHERE prev_close IS NOT NULL AND next_close IS NOT NULL),
{_split_parts("usable_rows", "trade_date_fmt, symbol")},
{_eliminated()}"""

CHECKS: dict[str, str] = {
    "ohlcv_bars": f"WITH {BARS_SQL} SELECT * FROM bars",
    "ohlcv_curated": f"WITH {_CURATED} SELECT * FROM curated",
    "series_strict": _treated(_STRICT_DAY, _STRICT_CLOSE, "%Y-%m-%d"),
    "series_lenient": _treated(_LENIENT_DAY, _LENIENT_CLOSE, "%d/%m/%Y"),
    "date_training": f"""WITH {RAW_QUOTES_SQL}
SELECT {_TRAINING_DAY} AS training_date, {_PADDED_DAY} AS padded_date, count(*) AS n FROM raw_quotes GROUP BY 1, 2""",
    "prev_next_close": f"WITH {_PREV_NEXT} SELECT * FROM complete",
    "next_close_ranks": f"WITH {_PREV_NEXT} SELECT *, row_number() OVER (ORDER BY {_TOTAL_ORDER}) AS rank FROM complete",
    "next_close_split": f"""WITH {_PREV_NEXT},
{_split_parts("complete", _TOTAL_ORDER)}
SELECT symbol, trade_date_fmt, close, prev_close, next_close, volume, part FROM parts""",
    "next_close_linear": f"""WITH {_NEXT_CLOSE}
{" UNION ALL ".join(f"SELECT '{x}' AS input, round(beta_{x}, 4) AS coefficient FROM model" for x in (*_INPUT_NAMES, "intercept"))}""",
    "next_close_linear_score": f"""WITH {_NEXT_CLOSE},
predicted AS (SELECT next_close AS y, beta_intercept + {" + ".join(f"beta_{x} * {x}" for x in _INPUT_NAMES)} AS p FROM parts, model WHERE part = 'validation')
SELECT round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, round(1 - avg((y - p) * (y - p)) / var_pop(y), 4) AS r2 FROM predicted""",
    "history_between": f"""WITH {BARS_SQL} SELECT * FROM bars WHERE symbol IN ('S1', 'S3', 'S7')
  AND date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'""",
    "curated_history": f"""WITH {BARS_SQL},
kept AS (
  SELECT * FROM bars WHERE date < DATE '1996-01-01' AND NOT (CAST(substr(symbol, 2) AS INTEGER) % 3 = 0 AND date >= DATE '1995-06-01')
  UNION ALL SELECT * REPLACE (close + 1 AS close) FROM bars WHERE CAST(substr(symbol, 2) AS INTEGER) % 3 = 0 AND date >= DATE '1995-06-01'
)
SELECT symbol, date AS trade_date_fmt, open, high, low, close, volume FROM kept
WHERE CAST(substr(symbol, 2) AS INTEGER) BETWEEN 1 AND 40 AND date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'""",
    "fixed_width_bars": f"""WITH {FIXED_LINES_SQL}
SELECT trim(substr(value, 11, 14)) AS symbol, try_strptime(substr(value, 3, 8), '%Y%m%d')::DATE AS trade_date,
  coalesce(TRY_CAST(nullif(trim(substr(value, 57, 13)), '') AS BIGINT), 0) / 100.0::DOUBLE AS open,
  coalesce(TRY_CAST(nullif(trim(substr(value, 70, 13)), '') AS BIGINT), 0) / 100.0::DOUBLE AS high,
  coalesce(TRY_CAST(nullif(trim(substr(value, 83, 13)), '') AS BIGINT), 0) / 100.0::DOUBLE AS low,
  coalesce(TRY_CAST(nullif(trim(substr(value, 122, 13)), '') AS BIGINT), 0) / 100.0::DOUBLE AS close,
  coalesce(TRY_CAST(nullif(trim(substr(value, 135, 13)), '') AS BIGINT), 0) AS volume
FROM fixed_lines WHERE starts_with(value, '01') AND length(value) >= 147""",
    "separator_by_file": f"""WITH {PRICE_LINES_SQL},
headers AS (SELECT path, arg_min(text, place) AS header FROM price_lines GROUP BY 1)
SELECT path, CASE WHEN length(header) - length(replace(header, ';', '')) >= length(header) - length(replace(header, ',', ''))
  THEN ';' ELSE ',' END AS separator FROM headers""",
    "separator_vote": f"""WITH {PRICE_LINES_SQL}, {_LAYOUT_LINES},
all_lines AS (SELECT path, text FROM price_lines UNION ALL SELECT 'layout-' || path, text FROM layout_lines),
marks AS (SELECT path, length(bare) - length(replace(bare, ';', '')) AS s, length(bare) - length(replace(bare, ',', '')) AS c
  FROM (SELECT path, regexp_replace(text, '"[^"]*"', '', 'g') AS bare FROM all_lines)),
votes AS (SELECT path, count(*) AS lines, min(s) = max(s) AND max(s) > 0 AS even_s, min(c) = max(c) AND max(c) > 0 AS even_c, sum(s) AS s, sum(c) AS c FROM marks GROUP BY 1)
SELECT path, CASE WHEN even_s AND NOT even_c THEN ';' WHEN even_c AND NOT even_s THEN ',' WHEN c > s THEN ',' ELSE ';' END AS separator, lines FROM votes""",
    "folder_ingest": f"""WITH {LAYOUT_ROWS_SQL}
SELECT symbol, date, CASE WHEN kind = 0 THEN replace(close, '.', ',') ELSE close END AS close, CASE WHEN kind IN (0, 3) THEN volume END AS volume,
  CASE WHEN kind = 2 THEN 'a;b' END AS "note 2", CASE WHEN kind = 3 THEN 'caf' || chr(65533) END AS flag3 FROM layout_rows""",
    "folder_findings": f"""WITH {LAYOUT_ROWS_SQL}
SELECT DISTINCT path AS file, 'separator' AS "check", 'warning' AS severity, 1::BIGINT AS observed FROM layout_rows WHERE kind IN (1, 3)
UNION ALL SELECT path, 'broken_bytes', 'warning', count(*) FROM layout_rows WHERE kind = 3 GROUP BY 1""",
    "landed_files": f"""WITH {_LAYOUT_LINES},
lines AS (SELECT path, place, text, replace(hex(encode(text)), 'C3A9', 'E9') AS bytes FROM layout_lines),
files AS (SELECT path, string_agg(bytes || '0D0A', '' ORDER BY place, text) AS whole FROM lines GROUP BY 1)
SELECT path, CAST(length(whole) // 2 AS BIGINT) AS bytes, sha256(unhex(whole)) AS sha256, CAST(ceil(length(whole) / 32768.0) AS BIGINT) AS pieces FROM files""",
    "inferred_types": f"""WITH {KINDS_SQL}, columns AS (
  {" UNION ALL ".join(f"SELECT '{x}' AS col, trim({x}) AS v FROM kinds" for x in KINDS)}),
marked AS (SELECT col, CASE WHEN v IS NULL OR v = '' THEN 0
  WHEN regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL THEN 1
  WHEN regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 2
  WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST(v AS DATE) IS NOT NULL THEN 4
  WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}(\\.[0-9]{{1,6}})?') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 8
  ELSE 16 END AS k FROM columns),
seen AS (SELECT col, bit_or(k) AS k, count(*) FILTER (WHERE k <> 0) AS filled FROM marked GROUP BY 1)
SELECT col AS "column", CASE WHEN k = 0 THEN 'null' WHEN k & 16 <> 0 OR (k & 3 <> 0 AND k & 12 <> 0) THEN 'text' WHEN k = 4 THEN 'date'
  WHEN k & 12 <> 0 THEN 'timestamp' WHEN k = 1 THEN 'long' ELSE 'double' END AS type, filled FROM seen""",
    "typed_rows": f"""WITH {KINDS_SQL}
SELECT name, CAST(sum(CAST(whole AS BIGINT)) AS BIGINT) AS whole, round(sum(CAST(trim(number) AS DOUBLE)), 2) AS number, max(TRY_CAST(nullif(day, '') AS DATE)) AS day,
  strftime(max(CAST(moment AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS moment, min(mixed) AS mixed, sum(CAST(large AS DOUBLE)) AS large, 0::BIGINT AS nothing,
  count(*) FILTER (WHERE bad_day = '1994-02-30') AS bad_days FROM kinds GROUP BY 1""",
    "union_mixed_files": f"""WITH {PRICE_LINES_SQL}
SELECT split_part(text, separator, 1) AS symbol, split_part(text, separator, 2) AS date,
  TRY_CAST(replace(split_part(text, separator, 3), ',', '.') AS DOUBLE) AS close,
  CASE WHEN separator = ',' THEN split_part(text, separator, 4) END AS volume
FROM price_lines WHERE place > 0""",
    "slug": """WITH named AS (SELECT p_name AS text FROM part UNION ALL SELECT '__' || c_name || '-ç/' FROM customer)
SELECT text, coalesce(nullif(trim(regexp_replace(text, '[^A-Za-z0-9]+', '_', 'g'), '_'), ''), 'dados') AS slug,
  coalesce(nullif(trim(regexp_replace(text, '[^\\p{L}\\p{N}_-]', '_', 'g'), '_'), ''), 'forecast') AS prefix FROM named""",
    "first_seen_symbols": f"""WITH {RAW_QUOTES_SQL},
firsts AS (SELECT symbol, min(position) AS f FROM raw_quotes GROUP BY 1)
SELECT symbol, CAST(f AS VARCHAR) AS position FROM firsts""",
    "drop_nth_symbol": f"""WITH {RAW_QUOTES_SQL},
firsts AS (SELECT coalesce(trim(symbol), 'nan') AS s, min(position) AS f FROM raw_quotes GROUP BY 1),
ranked AS (SELECT s, row_number() OVER (ORDER BY f, s) AS nth FROM firsts)
SELECT CAST(position AS VARCHAR) AS position, symbol, trade_date, close FROM raw_quotes
WHERE coalesce(trim(symbol), 'nan') NOT IN (SELECT s FROM ranked WHERE nth = 7)""",
    "dropped_ticker_report": f"""WITH {RAW_QUOTES_SQL},
firsts AS (SELECT coalesce(trim(symbol), 'nan') AS s, min(position) AS f, count(*) AS n FROM raw_quotes GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY f, s) AS nth FROM firsts)
SELECT s AS symbol, 'ticker_removed' AS "check", 'warning' AS severity, n AS observed,
  'ticker number 7 removed with ' || n || ' rows' AS message FROM ranked WHERE nth = 7""",
    "symbol_counts": f"WITH {BARS_SQL}, {_RANKED} SELECT * FROM ranked",
    "top_symbol": f"WITH {BARS_SQL}, {_RANKED} SELECT * FROM ranked LIMIT 1",
    "primary_symbol": f"""WITH {BARS_SQL}, {_RANKED}
SELECT symbol, date, close FROM bars WHERE symbol = (SELECT symbol FROM ranked LIMIT 1)""",
    "quality_report": f"""{_parsed(_STRICT_DAY, _STRICT_CLOSE)},
totals AS (
  SELECT symbol, count(DISTINCT date) FILTER (WHERE close IS NOT NULL) AS days,
    count(*) FILTER (WHERE date IS NULL OR close IS NULL) AS dropped,
    min(date) FILTER (WHERE close IS NOT NULL) AS first, max(date) FILTER (WHERE close IS NOT NULL) AS last
  FROM parsed GROUP BY 1
) {_FINDINGS}""",
    "guarded_findings": f"""{_parsed(_STRICT_DAY, _STRICT_CLOSE)}
SELECT 'day_known' AS name, 'divert' AS action, count(*) FILTER (date IS NULL) AS rows FROM parsed
UNION ALL SELECT 'close_known', 'divert', count(*) FILTER (close IS NULL) FROM parsed
UNION ALL SELECT 'symbol_known', 'warn', count(*) FILTER (symbol = 'UNKNOWN') FROM parsed
UNION ALL SELECT 'close_positive', 'warn', count(*) FILTER (close IS NULL OR close <= 0) FROM parsed""",
    "guarded_quotes": f"""{_parsed(_STRICT_DAY, _STRICT_CLOSE)}
SELECT symbol, date, close, CAST(position AS VARCHAR) AS position, CASE WHEN date IS NULL OR close IS NULL THEN concat_ws(',',
  CASE WHEN date IS NULL THEN 'day_known' END, CASE WHEN close IS NULL THEN 'close_known' END,
  CASE WHEN symbol = 'UNKNOWN' THEN 'symbol_known' END, CASE WHEN close IS NULL OR close <= 0 THEN 'close_positive' END) END AS broken FROM parsed""",
    "ticker_report": f"""WITH {RAW_QUOTES_SQL},
counted AS (SELECT 'file-' || CAST(position % 50 AS BIGINT) AS source, count(DISTINCT nullif(trim(symbol), '')) AS tickers FROM raw_quotes GROUP BY 1)
SELECT source AS symbol, 'several_tickers' AS "check", 'error' AS severity, tickers AS observed,
  'source holds ' || tickers || ' tickers' AS message FROM counted WHERE tickers > 1""",
    "top_symbol_close_trend": f"""WITH {BARS_SQL}, {_RANKED}
SELECT symbol, date, round(avg(close), 6) AS close FROM bars WHERE symbol IN (SELECT symbol FROM ranked LIMIT 6) GROUP BY 1, 2""",
    "top_symbol_volume_trend": f"""WITH {BARS_SQL}, {_RANKED}
SELECT symbol, date, round(avg(volume), 6) AS volume FROM bars WHERE symbol IN (SELECT symbol FROM ranked LIMIT 6) GROUP BY 1, 2""",
    "symbol_ohlc_frame": f"""WITH {BARS_SQL}
SELECT date, open, high, low, close, CAST(volume AS DOUBLE) / 1e6 AS volume_millions FROM bars WHERE symbol = 'S3'""",
    "profile": f"""WITH {BARS_SQL}, counted AS (SELECT symbol, count(*) AS n FROM bars GROUP BY 1)
{" UNION ALL ".join(_profile_part(name) for name in ("date", "open", "high", "low", "close", "volume"))}
UNION ALL SELECT 'symbol', CAST(sum(n) AS BIGINT), count(*), (SELECT symbol FROM counted ORDER BY n DESC, symbol LIMIT 1), max(n),
  NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM counted""",
    "correlation_matrix": f"""WITH {_CURATED},
varied AS (SELECT open, high, low, close, CAST(volume AS DOUBLE) AS volume, daily_pct_change, 1.0::DOUBLE AS unit FROM curated)
{_CORRELATIONS}""",
    "correlation_chart": f"""WITH {_CURATED},
varied AS (SELECT open, high, low, close, CAST(volume AS DOUBLE) AS volume, daily_pct_change, 1.0::DOUBLE AS unit FROM curated)
SELECT x, y, CASE WHEN correlation IS NOT NULL THEN format('{{:.2f}}', correlation) END AS label FROM ({_CORRELATIONS})""",
    "temporal_features": f"""WITH {BARS_SQL}, {_features()}
SELECT symbol, date, close, day_index, scale, {", ".join(f"round({name}, 6) AS {name}" for name in _NAMES)}, part FROM features""",
    "temporal_split": f"""WITH {BARS_SQL},
placed AS (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM bars),
parts AS (SELECT *, CASE WHEN rn <= {_SPLIT_SIZE.format(n="n")} THEN 'train' ELSE 'test' END AS part FROM placed)
SELECT symbol, part, count(*) AS rows, min(date) AS first, max(date) AS last FROM parts GROUP BY 1, 2""",
    "series_status": f"""WITH {BARS_SQL}, early AS (SELECT * REPLACE (symbol || '-' || year(date) || '-' ||
  CASE WHEN month(date) <= 6 THEN 'H1' WHEN month(date) <= 9 THEN 'Q3' ELSE CAST(month(date) AS VARCHAR) END AS symbol) FROM bars), {_features("early")},
raw AS (SELECT symbol, count(*) AS rows FROM early GROUP BY 1), built_rows AS (SELECT symbol, count(*) AS f FROM features GROUP BY 1)
SELECT symbol, rows, coalesce(f, 0) AS feature_rows, CASE WHEN rows < 10 THEN 'too_few_rows'
  WHEN coalesce(f, 0) < 14 THEN 'too_few_feature_rows' ELSE 'ok' END AS status FROM raw LEFT JOIN built_rows USING (symbol)""",
    "naive_baseline": f"WITH {_TEST_ROWS} SELECT symbol, date, close, naive FROM test",
    "naive_metrics": f"WITH {_TEST_ROWS} SELECT symbol, count(*) AS rows, {_errors('', 'naive')} FROM test GROUP BY 1",
    "backtest_folds": f"""WITH {_FOLDS}
SELECT * REPLACE ({", ".join(f"round({who}_{e}, 6) AS {who}_{e}" for who in ("model", "naive") for e in ("rmse", "mae", "r2"))}),
  model_rmse < naive_rmse AS model_beats_naive_rmse FROM folds""",
    "backtest_summary": f"""WITH {_FOLDS},
means AS (SELECT symbol, count(*) AS folds, avg(model_rmse) AS m, avg(naive_rmse) AS b FROM folds GROUP BY 1)
SELECT symbol, folds, round(m, 6) AS model_rmse_mean, round(b, 6) AS naive_rmse_mean, m < b AS model_beats_naive_in_mean_rmse FROM means""",
    "calibrated_predictions": f"""WITH {_TEST_ROWS},
blended AS (SELECT symbol, date, close, close * 0.75::DOUBLE + predicted * 0.25::DOUBLE AS predicted FROM test),
moments AS (SELECT symbol, avg(close) AS m FROM blended GROUP BY 1),
sums AS (
  SELECT symbol, any_value(m) AS m, sum((predicted - m) * (close - m)) AS a, sum((predicted - m) * (predicted - m)) AS b,
    sum((close - m) * (close - m)) AS s, sum((close - predicted) * (close - predicted)) AS e FROM blended JOIN moments USING (symbol) GROUP BY 1
),
factors AS (
  SELECT symbol, m, CASE WHEN s <= 0 THEN 1.0 ELSE 1.0 - e / s END AS r2,
    CASE WHEN s <= 0 THEN 0.0 WHEN 1.0 - e / s > 0.8 THEN (a - sqrt(greatest(0.0, a * a - 0.8 * s * b))) / b ELSE 1.0 END AS f FROM sums
),
applied AS (
  SELECT symbol, date, close, predicted, f * predicted + (1.0 - f) * m AS calibrated, least(r2, 0.8) AS calibrated_r2
  FROM blended JOIN factors USING (symbol)
)
SELECT symbol, date, close, round(predicted, 5) AS predicted, round(calibrated, 5) AS calibrated,
  round(CAST(calibrated_r2 AS DOUBLE), 5) AS calibrated_r2,
  round(CAST(greatest(0.6 - calibrated_r2, calibrated_r2 - 0.8, 0.0) AS DOUBLE), 5) AS distance FROM applied""",
    "ridge_moments": f"""WITH {BARS_SQL}, {_features()},
usable AS (SELECT *, avg(log_close) OVER (PARTITION BY symbol) AS center FROM features WHERE n >= 10 AND feature_rows >= 14)
SELECT symbol, part, count(*) AS n, round(max(center), 6) AS center,
  {", ".join(f"round(sum({_shifted(name)}), 4) AS sum_{name}" for name in _NAMES)},
  round(sum(t * {_shifted("log_close")}), 4) AS t_by_label, round(sum({_shifted("log_close")} * {_shifted("log_close")}), 4) AS label_by_label
FROM usable GROUP BY 1, 2""",
    "recursive_forecast_fixed": f"""WITH RECURSIVE {BARS_SQL}, {_features()},
starts AS (
  SELECT symbol, list(log_close ORDER BY place) FILTER (WHERE place > feature_rows - 7) AS h, max(scale) AS scale,
    max(last_date) AS last_date, CAST(date_diff('day', max(first_date), max(last_date)) AS DOUBLE) AS last_index
  FROM features WHERE n >= 10 AND feature_rows >= 14 GROUP BY 1
),
steps AS (
  SELECT symbol, h, scale, last_date, last_index, 0 AS i, CAST(NULL AS DOUBLE) AS p FROM starts
  UNION ALL
  SELECT symbol, list_append(h[2:7], p), scale, last_date, last_index, i, p FROM (
    SELECT s.symbol, s.h, s.scale, s.last_date, s.last_index, s.i + 1 AS i, {_STEP} AS p
    FROM (SELECT *, (last_index + i + 1) / scale AS t FROM steps WHERE i < 10) s, LATERAL (SELECT s.t AS t) x
  )
)
SELECT symbol, CAST(last_date + i AS DATE) AS date, round(exp(p) - 1, 4) AS predicted FROM steps WHERE i > 0""",
    "ridge_search": f"""WITH RECURSIVE {_FITS}
SELECT symbol, CAST(epochs AS INTEGER) AS epochs, reg_param, {", ".join(f"round({x}, 5) AS {x}" for x in ("train_r2", "r2", "rmse", "mae"))}, chosen AND epochs = 8 AS chosen
FROM search, (VALUES (8), (16), (32), (64), (128)) AS limits(epochs)""",
    "ridge_refit": f"""WITH RECURSIVE {_FITS},
sizes AS (
  SELECT symbol, count(*) FILTER (part = 'train') AS train_rows, count(*) FILTER (part = 'test') AS test_rows, max(scale) AS scale,
    max(first_date) AS first_date, max(last_date) AS last_date FROM usable GROUP BY 1
)
SELECT symbol, train_rows, test_rows, scale, first_date, last_date, reg_param, round(t.intercept, 4) AS train_intercept,
  round(f.intercept, 4) AS full_intercept, {", ".join(f"round(t.beta[{i + 1}], 5) AS train_{x}, round(f.beta[{i + 1}], 5) AS full_{x}" for i, x in enumerate(_INPUTS))}
FROM sizes JOIN search USING (symbol) JOIN fits t USING (symbol) JOIN fits f USING (symbol)
WHERE chosen AND t.fit = 'train' AND t.penalty = reg_param AND f.fit = 'full' AND f.penalty = reg_param""",
    "forecast_all": f"""WITH RECURSIVE {_FORECAST},
totals AS (
  SELECT symbol, max(reg_param) AS reg_param, count(*) FILTER (part = 'train') AS train_rows, count(*) FILTER (part = 'test') AS test_rows,
    max(last_date) AS forecast_anchor_date, max(calibrated_r2) FILTER (part = 'train') AS train_r2,
    max(calibrated_r2) FILTER (part = 'test') AS test_r2 FROM predictions GROUP BY 1
),
tested AS (SELECT symbol, {_errors("", "predicted", ", 10")}, {_errors("baseline_naive_", "naive", ", 10")} FROM past GROUP BY 1),
means AS (SELECT symbol, CAST(count(*) AS INTEGER) AS folds, avg(model_rmse) AS mm, avg(naive_rmse) AS nm FROM folds GROUP BY 1)
SELECT symbol, 3 AS iterations, CAST(NULL AS INTEGER) AS epochs, reg_param, train_rows, test_rows, 31 AS future_days, forecast_anchor_date,
  round(train_r2, 4) AS train_r2, round(test_r2, 4) AS r2, round(test_r2, 4) AS test_r2, 0.6::DOUBLE AS target_r2_min, 0.8::DOUBLE AS target_r2_max,
  train_r2 BETWEEN 0.6 AND 0.8 AS train_target_reached, test_r2 BETWEEN 0.6 AND 0.8 AS test_target_reached,
  train_r2 BETWEEN 0.6 AND 0.8 AND test_r2 BETWEEN 0.6 AND 0.8 AS target_reached, round(rmse, 4) AS rmse, round(mae, 4) AS mae,
  round(baseline_naive_rmse, 4) AS baseline_naive_rmse, round(baseline_naive_mae, 4) AS baseline_naive_mae,
  round(baseline_naive_r2, 4) AS baseline_naive_r2, rmse < baseline_naive_rmse AS model_beats_naive_rmse,
  'pyspark_linear_regression_lbfgs_log_scale_temporal_features' AS model, FALSE AS from_cache, folds, round(mm, 4) AS model_rmse_mean,
  round(nm, 4) AS naive_rmse_mean, mm < nm AS model_beats_naive_in_mean_rmse, 9 AS features
FROM totals JOIN (SELECT * EXCLUDE (r2) FROM tested) USING (symbol) JOIN means USING (symbol)""",
    "forecast_folds": f"""WITH RECURSIVE {_FORECAST}
SELECT * REPLACE ({", ".join(f"round({who}_{e}, 4) AS {who}_{e}" for who in ("model", "naive") for e in ("rmse", "mae", "r2"))}),
  model_rmse < naive_rmse AS model_beats_naive_rmse FROM folds""",
    "forecast_past": f"WITH RECURSIVE {_FORECAST} SELECT symbol, date, close, round(predicted, 3) AS predicted FROM past",
    "forecast_future": f"WITH RECURSIVE {_FORECAST} SELECT symbol, date, round(predicted, 3) AS predicted FROM future",
    "forecast_chart": f"""WITH RECURSIVE {_FORECAST}
{_LINE.format(series="actual", label="Dados reais", value="close", source="bars")}
UNION ALL {_LINE.format(series="past", label="Predicao passada (teste)", value="predicted", source="past")}
UNION ALL {_LINE.format(series="future", label="Predicao futura (31 dias)", value="predicted", source="future")}""",
    "series_fingerprint": f"""WITH {BARS_SQL},
hashed AS (SELECT symbol, date, {_DIGEST} AS d FROM bars),
totals AS (
  SELECT symbol, min(date) AS first, max(date) AS last, count(*) AS n,
    {", ".join(f"sum(CAST('0x' || substr(d, {1 + 15 * i}, 15) AS BIGINT)) AS lane{i}" for i in range(4))}
  FROM hashed GROUP BY 1
)
SELECT symbol, sha256(concat_ws('|', upper(symbol), strftime(first, '%Y-%m-%d'), strftime(last, '%Y-%m-%d'), CAST(n AS VARCHAR),
  '31', '0.20000000', 'DEMO', {", ".join(f"CAST(lane{i} AS VARCHAR)" for i in range(4))})) AS action_key FROM totals""",
    "run_counts": f"""WITH {RUNS_SQL}
SELECT symbol, count(*) AS total, max(updated_at) AS updated_at, least(count(*), 7) AS effective, count(*) >= 7 AS limit_reached
FROM runs GROUP BY 1""",
    "latest_runs": f"""WITH {RUNS_SQL}
SELECT run_key, symbol, run_number, updated_at FROM runs
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY updated_at DESC, run_key DESC) <= 7""",
    "retained_runs": f"""WITH {RUNS_SQL},
registered AS (
  SELECT 'run-' || CAST(run_number // 2 AS VARCHAR) AS run_key, symbol,
    CASE WHEN run_number % 5 > 1 THEN 'a-' || CAST(run_number % 97 AS VARCHAR) END AS action_key, run_number, updated_at, source_name FROM runs
),
newest AS (SELECT * FROM registered QUALIFY row_number() OVER (PARTITION BY run_key ORDER BY updated_at DESC, symbol DESC, run_number DESC) = 1),
of_ticker AS (SELECT * FROM newest QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY updated_at DESC, run_key DESC) <= 7)
SELECT * FROM of_ticker
QUALIFY action_key IS NULL OR row_number() OVER (PARTITION BY action_key ORDER BY updated_at DESC, run_key DESC) <= 7""",
    "model_input_text": f"""WITH {RAW_QUOTES_SQL},
typed AS (
  SELECT coalesce(nullif(trim(symbol), ''), 'ZED4') AS symbol, {_MONTH_FIRST_DAY} AS date, {_NUMBER.format(x="close")} AS close,
    {_NUMBER.format(x="high")} AS high, {_NUMBER.format(x="low")} AS low, {_NUMBER.format(x="volume")} AS volume, position FROM raw_quotes
)
SELECT symbol, date, close, high, low, volume FROM typed WHERE date IS NOT NULL AND close IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY position DESC) = 1""",
    "valid_runs": f"WITH {RUNS_SQL} SELECT run_key, symbol FROM valid",
    "reuse_plan": f"""WITH {RUNS_SQL},
kept AS (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY updated_at DESC, run_key DESC) <= 7),
full_runs AS (SELECT symbol, count(*) AS c, arg_max(run_key, row(updated_at, run_key)) AS latest FROM kept GROUP BY 1),
numbers AS (SELECT action_key, max(run_number) AS last_number FROM valid GROUP BY 1),
wanted AS (SELECT DISTINCT symbol, 'a-' || symbol AS action_key FROM runs)
SELECT symbol, action_key, coalesce(c, 0) AS valid_runs, CASE WHEN coalesce(c, 0) >= 7 THEN 'reuse' ELSE 'train' END AS decision,
  CASE WHEN coalesce(c, 0) < 7 THEN CAST(coalesce(last_number, 0) + 1 AS INTEGER) END AS run_number,
  CASE WHEN coalesce(c, 0) >= 7 THEN latest ELSE action_key || '::run-' || (coalesce(last_number, 0) + 1) END AS run_key
FROM wanted LEFT JOIN full_runs USING (symbol) LEFT JOIN numbers USING (action_key)""",
}

_KEYS = "symbol,run_key,train_r2,test_r2,target_r2_min,target_r2_max,train_target_reached,test_target_reached,target_reached,rmse,mae,epochs,iterations"
CHECKS["forecast_test_metrics"] = f"""SELECT symbol, 'run-' || symbol AS run_key, '{_KEYS}' AS keys, train_r2, test_r2, target_r2_min, target_r2_max, train_target_reached,
  test_target_reached, target_reached, rmse, mae, epochs, iterations FROM ({CHECKS["forecast_all"]})"""
CHECKS["forecast_exports"] = f"""WITH RECURSIVE {_FORECAST},
e_sizes AS (SELECT symbol, max(reg_param) AS reg_param, count(*) FILTER (part = 'train') AS train_rows, count(*) FILTER (part = 'test') AS test_rows FROM predictions GROUP BY 1),
e_tested AS (SELECT symbol, CAST(count(*) AS INTEGER) AS past_rows, min(date) AS past_first, sqrt(avg((close - predicted) * (close - predicted))) AS rmse FROM past GROUP BY 1),
e_ahead AS (SELECT symbol, CAST(count(*) AS INTEGER) AS future_rows, max(date) AS future_last FROM future GROUP BY 1),
e_folds AS (SELECT symbol, CAST(count(*) AS INTEGER) AS folds, CAST(sum(rows) AS BIGINT) AS fold_rows FROM folds GROUP BY 1)
SELECT 'run-' || symbol AS run_key, symbol, train_rows, test_rows, 3 AS attempts, past_rows, past_first, future_rows, future_last, folds, fold_rows, reg_param,
  CAST(NULL AS INTEGER) AS epochs, round(rmse, 4) AS rmse FROM e_sizes JOIN e_tested USING (symbol) JOIN e_ahead USING (symbol) JOIN e_folds USING (symbol)"""
CHECKS["registry_versions"] = f"""WITH {RUNS_SQL},
named AS (SELECT 'run-' || CAST(run_number // 3 AS VARCHAR) AS run_key, symbol, action_key, run_number, updated_at, source_name FROM runs)
SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY run_key ORDER BY updated_at DESC, run_number DESC) = 1"""
CHECKS["cached_results"] = f"""WITH plan AS ({CHECKS["reuse_plan"]}), counts AS ({CHECKS["run_counts"]}),
known AS (SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_key, CAST(event_id AS DOUBLE) AS rmse, 'U' || CAST(user_id AS VARCHAR) AS symbol FROM events
  UNION ALL SELECT run_key, -1.0::DOUBLE, symbol FROM plan WHERE decision = 'train')
SELECT run_key, rmse, k.symbol, action_key, effective AS ticker_reprocess_count, total AS ticker_processing_count_total, decision = 'reuse' AS from_cache,
  decision = 'reuse' AND limit_reached AS cache_limit_reached, least(valid_runs + CASE WHEN decision = 'reuse' THEN 0 ELSE 1 END, 7) AS action_reprocess_count,
  7 AS max_action_reprocessings
FROM known k JOIN plan USING (run_key) JOIN counts c ON c.symbol = k.symbol"""
CHECKS["named_month_dates"] = """WITH spelled AS (
  SELECT CASE l_orderkey % 5 WHEN 0 THEN strftime(l_shipdate, '%-d %b %Y') WHEN 1 THEN strftime(l_shipdate, '%B %-d, %Y')
      WHEN 2 THEN strftime(l_shipdate, '%d-%b-%Y') WHEN 3 THEN strftime(l_shipdate, '%b %d %Y %H:%M') ELSE '31 Feb ' || year(l_shipdate) END AS text,
    CASE WHEN l_orderkey % 5 < 4 THEN CAST(l_shipdate AS DATE) END AS date FROM lineitem)
SELECT text, any_value(date) AS date, count(*) AS n FROM spelled GROUP BY text"""
