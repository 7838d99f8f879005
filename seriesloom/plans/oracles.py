"""DuckDB SQL of the registered queries."""

from __future__ import annotations

from seriesloom.plans.queries import BRAND, CUTOFF, HORIZON, OFFSET, SPAN, YEAR_PART

AS_OF = "(SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)"


def _lines(key: str = "p_brand") -> str:
    return f"""lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_shipdate AS ts, l_linestatus AS fulfilled,
    p_brand || '-' || CAST(p_size AS VARCHAR) AS item_ref, l_quantity AS quant,
    CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END AS price, CAST({key} AS VARCHAR) AS series_id,
    CAST(l_shipdate AS DATE) AS date
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _daily(key: str = "p_brand") -> str:
    return f"""{_lines(key)}, daily AS (
  SELECT series_id, date, coalesce(sum(quant), 0) AS quant, coalesce(sum(price), 0) AS price,
    last(item_ref ORDER BY ts, order_id, item_ref) FILTER (WHERE item_ref IS NOT NULL) AS item_ref
  FROM lines WHERE series_id IS NOT NULL AND date IS NOT NULL GROUP BY series_id, date)"""


def _dense(key: str = "p_brand") -> str:
    return f"""{_daily(key)}, days AS (
  SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT series_id, min(date) AS a, max(date) AS b FROM daily GROUP BY series_id)), dense AS (
  SELECT days.series_id, days.date, coalesce(quant, 0) AS quant, coalesce(price, 0) AS price,
    first_value(item_ref IGNORE NULLS) OVER (PARTITION BY days.series_id ORDER BY days.date
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS item_ref
  FROM days LEFT JOIN daily ON daily.series_id = days.series_id AND daily.date = days.date), islands AS (
  SELECT *, date - CAST(row_number() OVER (PARTITION BY series_id, quant = 0 ORDER BY date) AS INTEGER) AS island FROM dense
), marked AS (
  SELECT series_id, date, CASE WHEN quant = 0 AND count(*) OVER (PARTITION BY series_id, quant = 0, island) > 7 THEN NULL
    ELSE quant END AS quant, price, item_ref FROM islands)"""


def _clean(key: str = "p_brand") -> str:
    return f"{_dense(key)}, clean AS (SELECT * FROM marked WHERE quant IS NOT NULL)"


def _features(key: str = "p_brand") -> str:
    return f"""{_clean(key)}, feat AS (
  SELECT *, lag(quant) OVER w AS lag_1,
    CASE WHEN count(*) OVER r = 3 THEN avg(quant) OVER r END AS rolling_mean_3,
    CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
    CASE WHEN quant <> 0 THEN price / quant END AS price_per_unit
  FROM clean WINDOW w AS (PARTITION BY series_id ORDER BY date),
    r AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


def _linear(horizon: int = HORIZON) -> str:
    """A line a step: the targets of all steps side by side by ``lead``, fitted in one grouping."""
    steps = range(1, horizon + 1)
    each = lambda f: "[" + ", ".join(f.format(h) for h in steps) + "]"
    leads = ", ".join(f"lead(quant, {h}) OVER w AS y{h}" for h in steps)
    return f"""{_features()}, numbered AS (
  SELECT series_id, lag_1, row_number() OVER w AS i, count(*) OVER (PARTITION BY series_id) AS n, {leads}
  FROM feat WINDOW w AS (PARTITION BY series_id ORDER BY date)), sums AS (
  SELECT series_id, {each("regr_slope(y{0}, lag_1)")} AS slopes, {each("regr_intercept(y{0}, lag_1)")} AS intercepts, {each("avg(y{0})")} AS means
  FROM numbered WHERE i <= n - {horizon} AND lag_1 IS NOT NULL GROUP BY series_id), fitted AS (
  SELECT series_id, unnest(range(1, {horizon + 1}))::INTEGER AS step, unnest(slopes) AS slope, unnest(intercepts) AS intercept, unnest(means) AS mean
  FROM sums), tail AS (
  SELECT series_id, lag_1 FROM numbered WHERE i = n), linear AS (
  SELECT fitted.series_id, step, {AS_OF} + step AS date,
    CASE WHEN slope IS NULL OR isnan(slope) OR tail.lag_1 IS NULL THEN mean ELSE intercept + slope * tail.lag_1 END AS prediction_raw
  FROM fitted JOIN tail ON fitted.series_id = tail.series_id)"""


def _flat() -> str:
    return f"""{_linear()}, flat AS (
  SELECT date, CAST(round_even(prediction_raw, 0) AS BIGINT) AS prediction, linear.series_id, item_ref
  FROM linear JOIN (SELECT series_id, arg_max(item_ref, date) AS item_ref FROM daily GROUP BY series_id) i ON i.series_id = linear.series_id)"""


def _holdout() -> str:
    return f"""{_features()}, split AS (
  SELECT *, CASE WHEN date < CAST(max(date) OVER (PARTITION BY series_id) - INTERVAL 1 MONTH AS DATE) THEN 'train' ELSE 'test' END AS split FROM feat
), fitted AS (
  SELECT series_id, regr_slope(quant, lag_1) AS slope, regr_intercept(quant, lag_1) AS intercept, avg(quant) AS mean
  FROM split WHERE split = 'train' AND lag_1 IS NOT NULL GROUP BY series_id), holdout AS (
  SELECT s.series_id, s.date, s.quant, CASE WHEN s.split = 'test' AND f.series_id IS NOT NULL THEN
    CASE WHEN slope IS NULL OR isnan(slope) OR s.lag_1 IS NULL THEN mean ELSE intercept + slope * s.lag_1 END END AS prediction
  FROM split s LEFT JOIN fitted f ON s.series_id = f.series_id)"""


def _profile(key: str = "l_partkey") -> str:
    return f"""{_clean(key)}, profile AS (
  SELECT series_id, min(date) AS first_date, max(date) AS last_date, count(*) AS rows,
    CAST(max(date) - min(date) AS INTEGER) AS span_days, count(*) FILTER (WHERE quant IS NULL OR isnan(quant)) AS missing_target
  FROM clean GROUP BY series_id), trains AS (
  SELECT series_id, count(*) FILTER (WHERE s = 'train') AS train_rows, count(*) FILTER (WHERE s = 'test') AS test_rows FROM (
    SELECT series_id, CASE WHEN date < CAST(max(date) OVER (PARTITION BY series_id) - INTERVAL 1 MONTH AS DATE) THEN 'train' ELSE 'test' END AS s
    FROM clean) GROUP BY series_id), gated AS (
  SELECT *, CASE WHEN last_date < {AS_OF} - 30 THEN 'inactive' WHEN rows < {HORIZON} + 15 THEN 'insufficient'
    WHEN rows <= {HORIZON} THEN 'empty_training' ELSE 'ok' END AS gate_reason FROM profile)"""


def _box(source: str, by: str, value: str, digits: int = 6) -> str:
    r = lambda x: f"round({x}, {digits})"
    return f"""{source}, q AS (
  SELECT {by}, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
  FROM b GROUP BY {by})
SELECT b.{by}, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
  {r(f'min({value}) FILTER (WHERE {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_low,
  {r(f'max({value}) FILTER (WHERE {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  count(*) FILTER (WHERE NOT {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers, count({value}) AS n
FROM b JOIN q ON b.{by} = q.{by} GROUP BY b.{by}, q1, median, q3"""


_HOURLY = "hourly AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, sum(value) AS value FROM events GROUP BY 1)"
_DAILY_COLUMNS = "series_id, date, round(quant, 6) AS quant, round(price, 6) AS price, item_ref"
_FEATURE_COLUMNS = f"{_DAILY_COLUMNS}, round(lag_1, 6) AS lag_1, round(rolling_mean_3, 6) AS rolling_mean_3, day_of_week, day_of_month, round(price_per_unit, 6) AS price_per_unit"
_A, _B = (f"DATE '{x}'" for x in SPAN)



def _comparable(sql: str) -> str:
    """``round(x, n)`` as ``queries.rounded`` does it."""
    while (at := sql.find("round(")) >= 0:
        depth, end = 0, at + len("round")
        while True:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            if not depth:
                break
            end += 1
        inner, digits = sql[at + len("round(") : end].rsplit(", ", 1)
        sql = f"{sql[:at]}floor(({inner}) * 1e{digits} + {OFFSET}) / 1e{digits}{sql[end + 1 :]}"
    return sql


_SQL = {
    "order_lines": f"WITH {_lines()} SELECT order_id, ts, fulfilled, item_ref, round(quant, 6) AS quant, round(price, 6) AS price, series_id FROM lines",
    "normalized_dates": "SELECT event_id, CAST(ts AS DATE) AS wall_clock, CAST(date_trunc('second', ts) + INTERVAL 3 HOUR AS DATE) AS utc FROM events",
    "daily_collapse": f"WITH {_daily()} SELECT {_DAILY_COLUMNS} FROM daily",
    "daily_collapse_sku": f"WITH {_lines()} SELECT item_ref AS sku, date, round(coalesce(sum(quant), 0), 6) AS quant, round(coalesce(sum(price), 0), 6) AS price FROM lines WHERE item_ref IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2",
    "dedup_daily": f"WITH {_lines('l_suppkey')} SELECT series_id, date, order_id, round(quant, 6) AS quant, round(price, 6) AS price FROM (SELECT *, row_number() OVER (PARTITION BY series_id, date ORDER BY ts, order_id, quant, price) AS n FROM lines) WHERE n = 1",
    "dense_daily": f"WITH {_dense()} SELECT {_DAILY_COLUMNS} FROM dense",
    "zero_runs_marked": f"WITH {_dense('l_suppkey')} SELECT {_DAILY_COLUMNS} FROM marked",
    "clean_daily": f"WITH {_clean()} SELECT {_DAILY_COLUMNS} FROM clean",
    "clean_daily_parts": f"WITH {_clean('l_partkey')} SELECT {_DAILY_COLUMNS} FROM clean",
    "features": f"WITH {_features()} SELECT {_FEATURE_COLUMNS} FROM feat",
    "complete_features": f"WITH {_features('l_suppkey')} SELECT series_id, date, round(quant, 6) AS quant, round(lag_1, 6) AS lag_1, round(rolling_mean_3, 6) AS rolling_mean_3, round(price_per_unit, 6) AS price_per_unit FROM feat WHERE lag_1 IS NOT NULL AND rolling_mean_3 IS NOT NULL AND price_per_unit IS NOT NULL",
    "calendar_features": f"WITH {_HOURLY} SELECT ts, round(value, 6) AS value, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(day(ts) AS INTEGER) AS day_of_month, CAST(week(ts) AS INTEGER) AS week_of_year, CAST(month(ts) AS INTEGER) AS month, CAST(quarter(ts) AS INTEGER) AS quarter, CAST(year(ts) AS INTEGER) AS year, CAST(dayofyear(ts) AS INTEGER) AS day_of_year FROM hourly",
    "hourly_series": f"WITH {_HOURLY} SELECT ts, round(value, 6) AS value FROM hourly",
    "legacy_sales": "SELECT p_brand AS SKU, CAST(l_shipdate AS DATE) AS DataEmissao, l_quantity AS Qtd FROM lineitem JOIN part ON l_partkey = p_partkey",
    "rounding": f"WITH {_daily('l_suppkey')} SELECT series_id, date, CAST(round_even(quant / 4, 0) AS BIGINT) AS units FROM daily",
    "series_slice": f"WITH {_daily()} SELECT {_DAILY_COLUMNS} FROM daily WHERE series_id = '{BRAND}' AND date BETWEEN {_A} AND {_B}",
    "open_range": f"WITH {_daily()} SELECT {_DAILY_COLUMNS} FROM daily WHERE date > {_A} AND date < {_B}",
    "outlier_filter": f"WITH {_daily()} SELECT {_DAILY_COLUMNS} FROM daily WHERE quant < 250",
    "series_calendar": f"WITH {_daily()}, days AS (SELECT CAST(unnest(generate_series({_A}, {_B}, INTERVAL 1 DAY)) AS DATE) AS date) SELECT '{BRAND}' AS series_id, days.date, round(quant, 6) AS quant, round(price, 6) AS price, item_ref FROM days LEFT JOIN daily ON daily.date = days.date AND daily.series_id = '{BRAND}'",
    "weekday_profile": f"WITH {_daily()} SELECT CAST(dayofweek(date) + 1 AS INTEGER) AS weekday_order, dayname(date) AS weekday, round(avg(quant), 6) AS mean_quant FROM daily GROUP BY 1, 2",
    "series_count": f"WITH {_daily('l_partkey')} SELECT count(DISTINCT series_id) AS series FROM daily",
    "series_list": f"WITH {_daily('l_partkey')} SELECT DISTINCT series_id FROM daily",
    "series_date_range": f"WITH {_daily('l_partkey')} SELECT series_id, min(date) AS first_date, max(date) AS last_date FROM daily GROUP BY GROUPING SETS ((series_id), ())",
    "box_weekday": _box(f"WITH {_daily()}, b AS (SELECT CAST(isodow(date) - 1 AS INTEGER) AS weekday, quant FROM daily)", "weekday", "quant"),
    "box_hour": _box(f"WITH {_HOURLY}, b AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, value FROM hourly)", "hour", "value", 4),
    "quantity_histogram": f"WITH {_daily()}, e AS (SELECT min(quant) AS lo, max(quant) AS hi FROM daily) SELECT CAST(least(floor((quant - lo) / ((hi - lo) / 100)) + 1, 100) AS INTEGER) AS bin, count(*) AS rows FROM daily, e GROUP BY 1",
    "sku_contract": f"WITH {_lines()} SELECT series_id, count(DISTINCT item_ref) AS items FROM lines GROUP BY series_id HAVING count(DISTINCT item_ref) > 1",
    "freshness": f"WITH {_daily()} SELECT max(date) AS last_date, CAST({AS_OF} + 10 - max(date) AS INTEGER) AS age_days, CASE WHEN {AS_OF} + 10 - max(date) > 30 THEN 'stale' ELSE 'fresh' END AS status FROM daily",
    "freshness_levels": f"WITH {_lines()} SELECT CAST({AS_OF} - max(date) AS INTEGER) AS age_days, CASE WHEN max(date) IS NULL THEN 'unparseable' WHEN {AS_OF} - max(date) > 7 THEN 'stale' WHEN {AS_OF} - max(date) > 2 THEN 'aging' ELSE 'fresh' END AS status FROM lines",
    "series_profile": f"WITH {_profile()} SELECT * FROM profile",
    "series_gate": f"WITH {_profile()} SELECT * FROM gated",
    "gate_summary": f"WITH {_profile()} SELECT coalesce(gate_reason, 'total') AS gate_reason, count(*) AS series FROM gated GROUP BY ROLLUP (gate_reason)",
    "series_gate_recursive": f"WITH {_profile()} SELECT p.*, t.train_rows, t.test_rows, CASE WHEN span_days < 365 THEN 'short_span' WHEN last_date < {AS_OF} - 30 THEN 'inactive' WHEN train_rows = 0 THEN 'empty_training' WHEN train_rows < 10 THEN 'insufficient' ELSE 'ok' END AS gate_reason FROM profile p JOIN trains t ON p.series_id = t.series_id",
    "series_gate_train": f"WITH {_profile()} SELECT *, CASE WHEN train_rows = 0 THEN 'empty_training' ELSE 'ok' END AS gate_reason FROM trains",
    "holdout_split": f"WITH {_clean()} SELECT series_id, date, round(quant, 6) AS quant, CASE WHEN date < CAST(max(date) OVER (PARTITION BY series_id) - INTERVAL 1 MONTH AS DATE) THEN 'train' ELSE 'test' END AS split FROM clean",
    "fixed_split": f"WITH {_clean()} SELECT series_id, date, round(quant, 6) AS quant, CASE WHEN date < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split FROM clean",
    "direct_frame": f"WITH {_features()}, ahead AS (SELECT series_id, date, lag_1, {', '.join(f'lead(quant, {k}) OVER w AS y_{k}' for k in range(1, HORIZON + 1))} FROM feat WINDOW w AS (PARTITION BY series_id ORDER BY date)) SELECT series_id, date, round(lag_1, 6) AS lag_1, {', '.join(f'round(y_{k}, 6) AS y_{k}' for k in range(1, HORIZON + 1))} FROM ahead WHERE y_{HORIZON} IS NOT NULL",
    "forecast_direct_linear_90": f"WITH {_linear(YEAR_PART)} SELECT series_id, step, date, round(prediction_raw, 4) AS prediction_raw, CAST(round_even(prediction_raw, 0) AS BIGINT) AS prediction FROM linear",
    "running_totals": f"WITH {_linear()} SELECT series_id, date, round(sum(prediction_raw) OVER (PARTITION BY series_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3) AS running_total FROM linear",
    "box_day": _box(f"WITH {_daily()}, b AS (SELECT CAST(day(date) AS INTEGER) AS day, quant FROM daily)", "day", "quant"),
    "box_month": _box(f"WITH {_daily()}, b AS (SELECT CAST(month(date) AS INTEGER) AS month, quant FROM daily)", "month", "quant"),
    "date_range": f"WITH {_daily()} SELECT 0 AS \"case\", min(date) AS first_date, max(date) AS last_date FROM daily WHERE series_id = '{BRAND}' UNION ALL SELECT 1, min(date), max(date) FROM daily UNION ALL SELECT 2, DATE '2024-05-06', DATE '2024-05-06'",
    "last_features": f"WITH {_features('l_partkey')} SELECT series_id, date, round(lag_1, 6) AS lag_1, round(rolling_mean_3, 6) AS rolling_mean_3, day_of_week, day_of_month, round(price_per_unit, 6) AS price_per_unit FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS n FROM feat) WHERE n = 1",
    "last_values": f"WITH {_clean('l_partkey')}, t AS (SELECT series_id, list(quant ORDER BY date) AS v FROM clean GROUP BY series_id), u AS (SELECT series_id, CASE WHEN len(v) < 3 THEN [v[-1], v[-1], v[-1]] ELSE v[-3:] END AS v FROM t) SELECT series_id, v[1] AS v1, v[2] AS v2, v[3] AS v3 FROM u",
    "future_calendar": f"WITH {_daily()}, s AS (SELECT DISTINCT series_id FROM daily), k AS (SELECT CAST(unnest(generate_series(1, {HORIZON})) AS INTEGER) AS step) SELECT series_id, step, {AS_OF} + step AS date FROM s, k",
    "forecast_direct_linear": f"WITH {_linear()} SELECT series_id, step, date, round(prediction_raw, 4) AS prediction_raw, CAST(round_even(prediction_raw, 0) AS BIGINT) AS prediction FROM linear",
    "horizon_totals": f"WITH {_linear()} SELECT series_id, round(sum(prediction_raw), 3) AS total, round(sum(prediction_raw) FILTER (WHERE date <= {AS_OF} + 10), 3) AS total_until FROM linear GROUP BY series_id",
    "actual_vs_pred": f"WITH {_holdout()} SELECT series_id, date, round(quant, 4) AS quant, round(prediction, 4) AS prediction FROM holdout",
    "forecast_rmse": f"WITH {_holdout()} SELECT series_id, round(sqrt(avg((quant - prediction) * (quant - prediction))), 4) AS rmse, count(*) AS n FROM holdout WHERE prediction IS NOT NULL GROUP BY series_id",
    "worst_days": f"WITH {_holdout()} SELECT date, round(avg(abs(quant - prediction)), 4) AS mean_error FROM holdout WHERE prediction IS NOT NULL GROUP BY date ORDER BY avg(abs(quant - prediction)) DESC, date LIMIT 10",
    "available_series": f"WITH {_clean()} SELECT DISTINCT series_id FROM clean",
    "forecast_scan": f"WITH {_flat()} SELECT * FROM flat",
    "forecast_slice": f"WITH {_flat()} SELECT * FROM flat WHERE series_id = '{BRAND}' AND date >= {AS_OF} ORDER BY date LIMIT 100",
    "forecast_page": f"WITH {_flat()} SELECT * FROM flat WHERE date > {AS_OF} + 10 OR (date = {AS_OF} + 10 AND series_id > '{BRAND}') ORDER BY date, series_id LIMIT 100",
}
ORACLES = {name: _comparable(sql) for name, sql in _SQL.items()}
