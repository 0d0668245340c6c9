"""The registered queries as DuckDB SQL over the same test tables."""

from __future__ import annotations

from hourwatt.plans.registry import KINDS, REGISTRY, nudge

_SQL_TYPES = {**KINDS, "ts": "TIMESTAMP", "i": "INTEGER", "s": "VARCHAR"}

AS_OF = "TIMESTAMP '2024-01-31 12:34:00'"
NOW_HOUR = "TIMESTAMP '2024-01-31 12:00:00'"
MID_MONTH_HOUR = "TIMESTAMP '2024-01-15 12:00:00'"
CREATED = "TIMESTAMP '2024-01-31 00:00:00'"


def _tables(series: int) -> str:
    key = "'all'" if series == 1 else f"CAST(user_id % {series} AS VARCHAR)"
    return f"""
ev AS (
  SELECT *, {key} AS series_id, date_trunc('hour', ts) AS timestamp_hour FROM events
),
bronze_demand AS (
  SELECT *, 0.95 * demand_mw AS generation_mw, CAST(NULL AS DOUBLE) AS forecast_demand_mw
  FROM (SELECT series_id, timestamp_hour,
               nullif(greatest(sum(value) - 5, 0), 0) AS demand_mw
        FROM ev WHERE event_type = 'click' GROUP BY 1, 2)
),
demand AS (SELECT * FROM bronze_demand WHERE demand_mw IS NOT NULL),
bronze_weather AS (
  SELECT series_id, timestamp_hour, avg(value) * 0.6 - 5 AS temp_c,
         avg(value) / 10 AS wind_speed_mps, avg(user_id % 360) AS wind_dir_deg
  FROM ev WHERE event_type = 'view' GROUP BY 1, 2
),
grid AS (
  SELECT series_id, unnest(generate_series(min(timestamp_hour), max(timestamp_hour),
                                           INTERVAL 1 HOUR)) AS timestamp_hour
  FROM bronze_demand GROUP BY 1
),
silver AS (
  SELECT series_id, timestamp_hour,
         last_value(demand_mw IGNORE NULLS) OVER w AS demand_mw,
         last_value(generation_mw IGNORE NULLS) OVER w AS generation_mw,
         forecast_demand_mw,
         last_value(temp_c IGNORE NULLS) OVER w AS temp_c,
         last_value(wind_speed_mps IGNORE NULLS) OVER w AS wind_speed_mps,
         last_value(wind_dir_deg IGNORE NULLS) OVER w AS wind_dir_deg
  FROM grid LEFT JOIN bronze_demand USING (series_id, timestamp_hour)
            LEFT JOIN bronze_weather USING (series_id, timestamp_hour)
  WINDOW w AS (PARTITION BY series_id ORDER BY timestamp_hour
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
weathered AS (SELECT * FROM silver WHERE temp_c IS NOT NULL AND demand_mw IS NOT NULL),
ahead AS (
  SELECT series_id, unnest(generate_series(max(timestamp_hour) + INTERVAL 1 HOUR,
                                           max(timestamp_hour) + INTERVAL 48 HOUR,
                                           INTERVAL 1 HOUR)) AS timestamp_hour
  FROM silver GROUP BY 1
),
profile AS (
  SELECT series_id, hour(timestamp_hour) AS h, avg(demand_mw) AS m, stddev_samp(demand_mw) AS sd
  FROM silver WHERE demand_mw IS NOT NULL GROUP BY 1, 2
),
gold_forecasts AS (
  SELECT a.series_id, a.timestamp_hour, 'run-1' AS run_id, {CREATED} AS created_at,
         m AS yhat, m - 1.2816 * coalesce(sd, 0) AS yhat_lower,
         m + 1.2816 * coalesce(sd, 0) AS yhat_upper
  FROM ahead a LEFT JOIN profile p
       ON a.series_id = p.series_id AND hour(a.timestamp_hour) = p.h
),
two_runs AS (
  SELECT * FROM gold_forecasts
  UNION ALL
  SELECT series_id, timestamp_hour, 'run-2' AS run_id, created_at + INTERVAL 1 DAY AS created_at,
         yhat * 1.1 AS yhat, yhat_lower * 1.1 AS yhat_lower, yhat_upper * 1.1 AS yhat_upper
  FROM gold_forecasts
),
shifted_runs AS (
  SELECT series_id, timestamp_hour + INTERVAL 1 DAY * (n - 1) AS timestamp_hour, n,
         yhat * (0.9 + n / 10.0) AS yhat, yhat_lower * (0.9 + n / 10.0) AS yhat_lower,
         yhat_upper * (0.9 + n / 10.0) AS yhat_upper
  FROM gold_forecasts, (VALUES (1), (2), (3)) AS night(n)
),
shifted_newest AS (
  SELECT * FROM shifted_runs QUALIFY row_number() OVER (PARTITION BY timestamp_hour ORDER BY n DESC) = 1
),
dispatch_hours AS (
  SELECT timestamp_hour,
         coalesce(sum(value) FILTER (event_type = 'click'), 0) AS price,
         least(coalesce(sum(value) FILTER (event_type = 'purchase'), 0) / 10, 50) AS charge_mwh,
         least(coalesce(sum(value) FILTER (event_type = 'signup'), 0) / 10, 50) AS discharge_mwh,
         least(coalesce(sum(value) FILTER (event_type = 'error'), 0) / 5, 100) AS soc_mwh
  FROM ev WHERE event_type IN ('click', 'purchase', 'signup', 'error') GROUP BY 1
),
dispatch_profits AS (
  SELECT *, greatest(price, 0) / 0.02 AS bid_mwh,
         price * (discharge_mwh - charge_mwh + greatest(price, 0) / 0.02) AS hour_profit
  FROM dispatch_hours
),
gold_dispatch AS (
  SELECT *, (SELECT sum(hour_profit) FROM dispatch_profits) AS expected_profit
  FROM dispatch_profits
),
dispatch_runs AS (
  SELECT * EXCLUDE (timestamp_hour, soc_mwh, charge_mwh),
         CASE WHEN n = 1 THEN timestamp_hour ELSE timestamp_hour + INTERVAL 40 DAY END AS timestamp_hour,
         CASE WHEN n = 1 THEN 'run-1' ELSE 'run-2' END AS run_id,
         CASE WHEN n = 3 THEN 'other' ELSE 'base' END AS scenario_id,
         CASE WHEN n = 1 THEN soc_mwh ELSE soc_mwh / 2 END AS soc_mwh,
         CASE WHEN n = 3 THEN charge_mwh / 4 ELSE charge_mwh END AS charge_mwh
  FROM gold_dispatch, (VALUES (1), (2), (3)) AS copy(n)
),
dispatch_newest AS (
  SELECT * FROM dispatch_runs
  QUALIFY row_number() OVER (PARTITION BY scenario_id, timestamp_hour ORDER BY run_id DESC) = 1
),
weather_raw AS (
  SELECT event_id, ts AS seen, timestamp_hour,
         CASE WHEN event_id % 50 = 0 THEN '+9999,9' WHEN event_id % 77 = 0 THEN ''
              ELSE concat('+', lpad(CAST(CAST(floor(value) AS INTEGER) AS VARCHAR), 4, '0'), ',1')
         END AS tmp,
         CASE WHEN event_id % 61 = 0 THEN '170,1'
              ELSE concat(lpad(CAST(user_id % 360 AS VARCHAR), 3, '0'), ',1,N,',
                          lpad(CAST(CAST(floor(value) AS INTEGER) AS VARCHAR), 4, '0'), ',1')
         END AS wnd
  FROM ev WHERE event_type = 'view'
),
weather_codes AS (
  SELECT seen, timestamp_hour,
         TRY_CAST(split_part(tmp, ',', 1) AS INTEGER) AS t,
         TRY_CAST(nullif(split_part(wnd, ',', 4), '') AS INTEGER) AS s,
         TRY_CAST(split_part(wnd, ',', 1) AS DOUBLE) AS d
  FROM weather_raw
),
weather_obs AS (
  SELECT seen, timestamp_hour,
         CASE WHEN abs(t) <> 9999 THEN t / 10.0 END AS temp_c,
         CASE WHEN abs(s) <> 9999 THEN s / 10.0 END AS wind_speed_mps,
         CASE WHEN d <> 999 THEN d END AS wind_dir_deg
  FROM weather_codes
),
weather_means AS (
  SELECT timestamp_hour, avg(temp_c) AS temp_c, avg(wind_speed_mps) AS wind_speed_mps,
         (round(degrees(atan2(avg(sin(radians(wind_dir_deg))), avg(cos(radians(wind_dir_deg))))), 9)
          + 360) % 360 AS wind_dir_deg
  FROM weather_obs GROUP BY 1
),
landed AS (
  SELECT event_id, event_type, timestamp_hour, value,
         CASE WHEN event_id % 97 <> 0 THEN value END AS demand_mw
  FROM ev WHERE event_type = 'click'
),
order_months AS (
  SELECT o_orderdate AS timestamp_hour, o_totalprice AS demand_mw FROM orders
  WHERE o_totalprice IS NOT NULL
)"""


def _silver_from(demand: str, weather: str) -> str:
    return f"""
SELECT timestamp_hour,
       last_value(demand_mw IGNORE NULLS) OVER w AS demand_mw,
       0.95 * last_value(demand_mw IGNORE NULLS) OVER w AS generation_mw,
       CAST(NULL AS DOUBLE) AS forecast_demand_mw,
       last_value(temp_c IGNORE NULLS) OVER w AS temp_c,
       last_value(wind_speed_mps IGNORE NULLS) OVER w AS wind_speed_mps,
       last_value(wind_dir_deg IGNORE NULLS) OVER w AS wind_dir_deg
FROM grid LEFT JOIN ({demand}) USING (timestamp_hour) LEFT JOIN ({weather}) USING (timestamp_hour)
WINDOW w AS (ORDER BY timestamp_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _overview(names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS row_count,
       min(timestamp_hour) AS earliest_data, max(timestamp_hour) AS latest_data,
       count(DISTINCT CAST(timestamp_hour AS DATE)) AS unique_days FROM {table}"""
        for name, table in names.items()
    )


_CORE = {
    "bronze_demand": "bronze_demand",
    "bronze_weather": "bronze_weather",
    "silver_demand_weather": "silver",
}
_ALL = {**_CORE, "gold_forecasts": "gold_forecasts", "gold_dispatch": "gold_dispatch"}

_STATS = """avg(demand_mw) AS avg_demand_mw, min(demand_mw) AS min_demand_mw,
       max(demand_mw) AS max_demand_mw"""

_MISSING = """
SELECT 'bronze_demand' AS table_name, count(*) AS total_rows, count(demand_mw) AS non_null_demand,
       count(*) - count(demand_mw) AS missing_demand,
       round((count(*) - count(demand_mw)) / count(*) * 100, 2) AS missing_pct FROM bronze_demand
UNION ALL
SELECT 'bronze_weather' AS table_name, count(*) AS total_rows, count(temp_c) AS non_null_demand,
       count(*) - count(temp_c) AS missing_demand,
       round((count(*) - count(temp_c)) / count(*) * 100, 2) AS missing_pct FROM bronze_weather"""

_OUTLIERS = """
SELECT timestamp_hour, demand_mw, z_score FROM (
  SELECT timestamp_hour, demand_mw,
         abs(demand_mw - (SELECT avg(demand_mw) FROM demand))
         / (SELECT stddev_samp(demand_mw) FROM demand) AS z_score FROM demand)
WHERE z_score > 3 ORDER BY z_score DESC, timestamp_hour"""

_CORR = """
SELECT CAST(timestamp_hour AS DATE) AS date, avg(temp_c) AS avg_temp_c,
       avg(demand_mw) AS avg_demand_mw,
       CASE WHEN stddev_pop(temp_c) > 0 AND stddev_pop(demand_mw) > 0
            THEN corr(temp_c, demand_mw) END AS temp_demand_correlation
FROM weathered GROUP BY 1 HAVING count(*) >= 20 ORDER BY date DESC"""


def _fresh(names: dict[str, str], as_of: str = AS_OF) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, max(timestamp_hour) AS latest_data,
       epoch({as_of} - max(timestamp_hour)) / 3600.0 AS lag_hours FROM {table}"""
        for name, table in names.items()
    )


def _rolling(by: str, extra: str = "") -> str:
    return f"""
SELECT {by} timestamp_hour, demand_mw,
       avg(demand_mw) OVER (PARTITION BY series_id ORDER BY timestamp_hour
                            ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_24h_avg,
       avg(demand_mw) OVER (PARTITION BY series_id ORDER BY timestamp_hour
                            ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS rolling_7d_avg
       {extra}
FROM demand ORDER BY timestamp_hour DESC"""


def _dispatch_daily(profit: str) -> str:
    return f"""
SELECT CAST(timestamp_hour AS DATE) AS date, sum(charge_mwh) AS total_charge_mwh,
       sum(discharge_mwh) AS total_discharge_mwh, avg(soc_mwh) AS avg_soc_mwh,
       max(soc_mwh) AS max_soc_mwh, min(soc_mwh) AS min_soc_mwh, sum({profit}) AS daily_profit
FROM gold_dispatch GROUP BY 1"""


def _profits(column: str) -> str:
    return f"""sum({column}) AS total_profit, avg({column}) AS avg_hourly_profit,
       max({column}) AS max_hourly_profit, min({column}) AS min_hourly_profit"""


def _forecast_daily(table: str) -> str:
    return f"""
SELECT CAST(timestamp_hour AS DATE) AS forecast_date, avg(yhat) AS avg_forecast_mw,
       avg(yhat_lower) AS avg_lower_bound, avg(yhat_upper) AS avg_upper_bound,
       avg(yhat_upper - yhat_lower) AS avg_confidence_interval, count(*) AS forecast_points
FROM {table} GROUP BY 1 ORDER BY 1 DESC LIMIT 10"""


def _merit(load: str) -> str:
    def output(below: int, cap: int) -> str:
        return f"CASE WHEN {load} IS NOT NULL THEN least(greatest({load} - {below}, 0), {cap}) END"

    wind, solar, gas = output(0, 300), output(300, 500), output(800, 800)
    return f"""{wind} AS wind_mw, {solar} AS solar_mw, {gas} AS gas_mw,
       ({wind}) * 0.03 + ({solar}) * 0.05 + ({gas}) * 0.08 AS cost,
       CASE WHEN {load} IS NOT NULL THEN greatest({load} - 1600, 0) END AS unserved_mw"""


def _fast_battery(day: str) -> str:
    """Value of each end level; such a battery is empty, full, or as full as before."""
    return f"""
  WITH RECURSIVE steps AS (
    SELECT *, count(*) OVER (PARTITION BY series_id, day) AS total
    FROM (SELECT series_id, {day} AS day, demand_mw AS price,
                 row_number() OVER (PARTITION BY series_id, {day} ORDER BY timestamp_hour) AS n
          FROM demand)
  ),
  states AS (
    SELECT DISTINCT series_id, day, CAST(0 AS BIGINT) AS n, 50 AS level, CAST(0 AS DOUBLE) AS v
    FROM steps
    UNION ALL
    SELECT series_id, day, n, level, max(v) AS v FROM (
      SELECT s.series_id, s.day, p.n, m.level AS level,
             s.v + p.price * CASE WHEN m.level < s.level THEN (s.level - m.level) * 0.95
                                  ELSE -(m.level - s.level) / 0.95 END AS v
      FROM states s JOIN steps p ON p.series_id = s.series_id AND p.day = s.day AND p.n = s.n + 1
           JOIN (VALUES (0), (50), (100)) AS m(level) ON m.level <> 50 OR s.level = 50)
    GROUP BY 1, 2, 3, 4
  )
  SELECT s.* FROM states s JOIN (SELECT DISTINCT series_id, day, total FROM steps) e
    ON e.series_id = s.series_id AND e.day = s.day AND e.total = s.n"""


_LEAST_COST = """
SELECT d.series_id, d.day, hours, CASE WHEN c.cost IS NULL THEN 'infeasible' ELSE 'optimal' END AS status,
       c.cost AS total_cost
FROM (SELECT series_id, CAST(timestamp_hour AS DATE) AS day, count(*) AS hours FROM silver
      WHERE demand_mw IS NOT NULL GROUP BY 1, 2) d
LEFT JOIN (
  WITH RECURSIVE steps AS (
    SELECT *, count(*) OVER (PARTITION BY series_id, day) AS total
    FROM (SELECT series_id, CAST(timestamp_hour AS DATE) AS day,
                 CAST(floor(demand_mw * 6 / 10) * 10 AS INTEGER) AS load,
                 row_number() OVER (PARTITION BY series_id, CAST(timestamp_hour AS DATE)
                                    ORDER BY timestamp_hour) AS n
          FROM silver WHERE demand_mw IS NOT NULL)
  ),
  states AS (
    SELECT DISTINCT series_id, day, CAST(0 AS BIGINT) AS n, 50 AS level, CAST(0 AS DOUBLE) AS cost
    FROM steps
    UNION ALL
    SELECT series_id, day, n, level, min(cost) AS cost FROM (
      SELECT s.series_id, s.day, p.n, m.level,
             s.cost + 0.03 * least(greatest(p.load + m.level - s.level, 0), 300)
                    + 0.05 * least(greatest(p.load + m.level - s.level - 300, 0), 500)
                    + 0.08 * least(greatest(p.load + m.level - s.level - 800, 0), 800) AS cost
      FROM states s JOIN steps p ON p.series_id = s.series_id AND p.day = s.day AND p.n = s.n + 1
           JOIN (SELECT unnest(range(10, 101, 10)) AS level) m
             ON p.load + m.level - s.level <= 1600)
    GROUP BY 1, 2, 3, 4
  )
  SELECT s.series_id, s.day, min(s.cost) AS cost
  FROM states s JOIN (SELECT DISTINCT series_id, day, total FROM steps) e
    ON e.series_id = s.series_id AND e.day = s.day AND e.total = s.n
  GROUP BY 1, 2) c ON c.series_id = d.series_id AND c.day = d.day"""


def _spread(position: str, table: str) -> str:
    return f"""
SELECT {position} AS position, min(demand_mw) AS min_value,
       quantile_cont(demand_mw, 0.25) AS q1, quantile_cont(demand_mw, 0.5) AS median,
       quantile_cont(demand_mw, 0.75) AS q3, max(demand_mw) AS max_value
FROM {table} GROUP BY 1"""


def _corr_pair(x: str, y: str) -> str:
    return f"""SELECT '{x}' AS left_column, '{y}' AS right_column, corr({x}, {y}) AS correlation
FROM silver"""


_LANDED_DAY = "SELECT timestamp_hour, max(demand_mw) AS demand_mw FROM landed GROUP BY 1"
_LATEST_DEMAND = """SELECT timestamp_hour, arg_max(value, event_id) AS demand_mw
FROM ev WHERE event_type = 'click' GROUP BY 1"""
_BATTERIES = """(VALUES ('base', 100.0, 50.0, 0.01), ('unit', 1.0, 1.0, 0.01),
                ('large', 200.0, 25.0, 0.01)) AS b(scenario_id, s_max, p_max, lam)"""

BODIES: dict[str, str] = {
    "table_overview": _overview(_ALL),
    "table_overview_core": _overview(_CORE),
    "missing_data": _MISSING,
    "demand_outliers": _OUTLIERS + " LIMIT 20",
    "demand_outliers_top10": _OUTLIERS + " LIMIT 10",
    "demand_outliers_by_series": """
SELECT series_id, timestamp_hour, demand_mw, abs(demand_mw - m) / sd AS z_score
FROM demand JOIN (SELECT series_id, avg(demand_mw) AS m, stddev_samp(demand_mw) AS sd
                  FROM demand GROUP BY 1) USING (series_id)
WHERE abs(demand_mw - m) / sd > 3""",
    "freshness": _fresh(_ALL),
    "quality_gate": f"""
SELECT check_name, table_name, value, limit_value,
       CASE WHEN check_name = 'row_count' THEN value >= limit_value
            ELSE coalesce(value <= limit_value, false) END AS passed
FROM (
  SELECT 'row_count' AS check_name, table_name, row_count AS value, 1.0 AS limit_value
  FROM ({_overview(_ALL)})
  UNION ALL SELECT 'unsolved_hours', 'gold_dispatch', 0.0, 0.0
  UNION ALL SELECT 'missing_pct', table_name, missing_pct, 10.0 FROM ({_MISSING})
  UNION ALL SELECT 'lag_hours', table_name, lag_hours, 72.0 FROM ({_fresh(_CORE)})
  UNION ALL SELECT 'outlier_pct', 'bronze_demand',
                   (SELECT count(*) FROM ({_OUTLIERS})) * 100.0 / (SELECT count(*) FROM demand), 5.0
  UNION ALL SELECT 'duplicate_keys', table_name, 0.0, 0.0 FROM ({_overview(_ALL)})
)""",
    "duplicate_keys": """
SELECT series_id, timestamp_hour, count(*) AS copies FROM ev WHERE event_type = 'click'
GROUP BY 1, 2 HAVING count(*) > 1""",
    "daily_demand": f"""
SELECT CAST(timestamp_hour AS DATE) AS date, {_STATS}, stddev_samp(demand_mw) AS demand_stddev,
       count(*) AS hourly_readings FROM demand GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
    "hourly_profile": f"""
SELECT hour(timestamp_hour) AS hour_of_day, {_STATS}, count(*) AS sample_count
FROM demand GROUP BY 1""",
    "hourly_profile_by_series": f"""
SELECT series_id, hour(timestamp_hour) AS hour_of_day, {_STATS}, count(*) AS sample_count
FROM demand GROUP BY 1, 2""",
    "weekday_profile": f"""
SELECT dayofweek(timestamp_hour) + 1 AS day_of_week, dayname(timestamp_hour) AS day_name, {_STATS}
FROM demand GROUP BY 1, 2""",
    "monthly_demand": f"""
SELECT month(timestamp_hour) AS month, year(timestamp_hour) AS year, {_STATS},
       count(*) AS hourly_readings FROM order_months GROUP BY 1, 2""",
    "monthly_seasonality": """
SELECT month(timestamp_hour) AS month, avg(demand_mw) AS seasonal_avg,
       min(demand_mw) AS seasonal_min, max(demand_mw) AS seasonal_max, count(*) AS sample_size
FROM order_months GROUP BY 1""",
    "mom_growth": """
SELECT year, month, avg_demand_mw, lag(avg_demand_mw) OVER w AS prev_month_avg,
       avg_demand_mw - lag(avg_demand_mw) OVER w AS month_over_month_change
FROM (SELECT year(timestamp_hour) AS year, month(timestamp_hour) AS month,
             avg(demand_mw) AS avg_demand_mw FROM order_months GROUP BY 1, 2)
WINDOW w AS (ORDER BY year, month)""",
    "peak_days": """
SELECT CAST(timestamp_hour AS DATE) AS date, max(demand_mw) AS peak_demand_mw,
       arg_max(hour(timestamp_hour), (demand_mw, -epoch(timestamp_hour))) AS peak_hour
FROM demand GROUP BY 1 ORDER BY peak_demand_mw DESC, date LIMIT 20""",
    "rolling_averages": _rolling("") + " LIMIT 100",
    "rolling_averages_all_rows": _rolling("series_id,"),
    "rolling_30d": _rolling(
        "",
        """, avg(demand_mw) OVER (PARTITION BY series_id ORDER BY timestamp_hour
                            ROWS BETWEEN 719 PRECEDING AND CURRENT ROW) AS rolling_30d_avg""",
    )
    + " LIMIT 100",
    "volatility_days": """
SELECT CAST(timestamp_hour AS DATE) AS date, min(demand_mw) AS min_demand,
       max(demand_mw) AS max_demand, max(demand_mw) - min(demand_mw) AS daily_range,
       stddev_samp(demand_mw) AS daily_volatility, count(*) AS hourly_readings
FROM demand GROUP BY 1 HAVING count(*) >= 20 ORDER BY daily_range DESC, date LIMIT 20""",
    "efficiency_daily": """
SELECT CAST(timestamp_hour AS DATE) AS date, avg(demand_mw) AS avg_demand,
       avg(generation_mw) AS avg_generation,
       avg(generation_mw) / avg(demand_mw) AS efficiency_ratio, count(*) AS hourly_readings
FROM demand WHERE generation_mw IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
    "temp_demand_corr": _CORR + " LIMIT 30",
    "temp_demand_corr_newest10": _CORR + " LIMIT 10",
    "temp_demand_corr_stored": _CORR + " LIMIT 5",
    "temp_bucket_impact": """
SELECT CASE WHEN temp_c < 10 THEN 'Cold (<10°C)' WHEN temp_c BETWEEN 10 AND 25
            THEN 'Moderate (10-25°C)' WHEN temp_c > 25 THEN 'Hot (>25°C)' END AS temp_category,
       count(*) AS hours, avg(demand_mw) AS avg_demand_mw, avg(wind_speed_mps) AS avg_wind_speed
FROM weathered GROUP BY 1""",
    "weather_clean": """
SELECT * FROM weather_obs
WHERE CAST(seen AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'""",
    "weather_clean_sentinels": """
SELECT timestamp_hour, t / 10.0 AS temp_c, s / 10.0 AS wind_speed_mps, d AS wind_dir_deg
FROM weather_codes""",
    "weather_hourly": "SELECT * FROM weather_means",
    "weather_feed_json": """
SELECT * FROM weather_obs
WHERE CAST(seen AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "demand_feed_json": "SELECT timestamp_hour, demand_mw FROM landed",
    "demand_feed_select": """
SELECT strftime(ts + INTERVAL 1 DAY * days, '%Y-%m-%dT%H:%M:%S') AS period,
       CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) AS value, 'D' AS type
FROM events, (VALUES (0), (365)) AS again(days) WHERE event_id % 8 <> 0
ORDER BY period DESC, value DESC LIMIT 10000""",
    "first_non_empty_feed": "SELECT * FROM bronze_demand",
    "demand_clean": """
SELECT timestamp_hour, value AS demand_mw, 0.95 * value AS generation_mw,
       CAST(NULL AS DOUBLE) AS forecast_demand_mw
FROM ev WHERE event_type = 'click'
  AND timestamp_hour >= TIMESTAMP '2025-01-14 12:00:00' - INTERVAL 365 DAY""",
    "latest_per_key": f"""
SELECT *, 0.95 * demand_mw AS generation_mw, CAST(NULL AS DOUBLE) AS forecast_demand_mw
FROM ({_LATEST_DEMAND})""",
    "silver_build": "SELECT * FROM silver",
    "silver_build_by_series": "SELECT * FROM silver",
    "silver_build_from_duplicates": _silver_from(_LATEST_DEMAND, "SELECT * FROM weather_means"),
    "feed_rejects": """
SELECT 'bronze_demand' AS table_name, sum(n + 1) AS rows_landed, count(*) AS rows_rejected
FROM (SELECT count(*) AS n FROM ev WHERE event_type IN ('click', 'error') GROUP BY event_id // 5000)""",
    "nightly_silver": """
WITH latest AS (
  SELECT series_id, timestamp_hour, CASE WHEN event_id % 97 <> 0 THEN value END AS demand_mw
  FROM ev WHERE event_type = 'click'
  QUALIFY row_number() OVER (PARTITION BY series_id, timestamp_hour ORDER BY event_id DESC) = 1
), station AS (
  SELECT series_id AS station, timestamp_hour,
         avg(CASE WHEN event_id % 50 <> 0 AND event_id % 77 <> 0 THEN floor(value) / 10 END) AS temp_c,
         avg(CASE WHEN event_id % 61 <> 0 THEN floor(value) / 10 END) AS wind_speed_mps
  FROM ev WHERE event_type = 'view' GROUP BY 1, 2
), seen AS (
  SELECT s.series_id, timestamp_hour, temp_c, wind_speed_mps
  FROM station JOIN (VALUES ('0', '0'), ('1', '1'), ('2', '0'), ('3', '1'), ('4', '0'))
       AS s(series_id, station) USING (station)
)
SELECT series_id, timestamp_hour, last_value(demand_mw IGNORE NULLS) OVER w AS demand_mw,
       0.95 * last_value(demand_mw IGNORE NULLS) OVER w AS generation_mw,
       last_value(temp_c IGNORE NULLS) OVER w AS temp_c,
       last_value(wind_speed_mps IGNORE NULLS) OVER w AS wind_speed_mps
FROM grid LEFT JOIN latest USING (series_id, timestamp_hour)
          LEFT JOIN seen USING (series_id, timestamp_hour)
WINDOW w AS (PARTITION BY series_id ORDER BY timestamp_hour
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "nightly_gold": f"""
SELECT series_id, scenario_id, count(*) AS hours, min(timestamp_hour) AS first_hour,
       max(timestamp_hour) AS last_hour, sum(greatest(0, yhat / (2 * lam))) AS bids, 0 AS broken
FROM gold_forecasts, {_BATTERIES} WHERE timestamp_hour >= {NOW_HOUR} GROUP BY 1, 2""",
    "silver_in_batches": """
WITH latest AS (
  SELECT series_id, timestamp_hour, CASE WHEN event_id % 5 <> 0 THEN value END AS demand_mw
  FROM ev WHERE event_type = 'click'
  QUALIFY row_number() OVER (PARTITION BY series_id, timestamp_hour ORDER BY ts DESC) = 1
)
SELECT series_id, timestamp_hour, last_value(demand_mw IGNORE NULLS) OVER w AS demand_mw,
       0.95 * last_value(demand_mw IGNORE NULLS) OVER w AS generation_mw,
       CAST(NULL AS DOUBLE) AS forecast_demand_mw,
       last_value(temp_c IGNORE NULLS) OVER w AS temp_c,
       last_value(wind_speed_mps IGNORE NULLS) OVER w AS wind_speed_mps,
       last_value(wind_dir_deg IGNORE NULLS) OVER w AS wind_dir_deg
FROM grid LEFT JOIN latest USING (series_id, timestamp_hour)
          LEFT JOIN bronze_weather USING (series_id, timestamp_hour)
WINDOW w AS (PARTITION BY series_id ORDER BY timestamp_hour
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "hour_grid": "SELECT * FROM grid",
    "future_hours": "SELECT * FROM ahead",
    "forward_fill_gaps": "SELECT * FROM silver",
    "table_scan": f"SELECT * FROM gold_forecasts WHERE timestamp_hour >= {AS_OF}",
    "append_rows": """
SELECT series_id, 2 * count(*) AS copies, 2 * sum(demand_mw) AS demand_total
FROM bronze_demand GROUP BY 1""",
    "replace_table": "SELECT * FROM silver",
    "day_partitioned_gold": """
SELECT CAST(timestamp_hour AS DATE) AS event_date, * FROM two_runs""",
    "conform_schema": "SELECT *, CAST(NULL AS DOUBLE) AS g, CAST(NULL AS TIMESTAMP) AS loaded_at"
    " FROM (SELECT series_id, demand_mw, CAST(NULL AS DOUBLE) AS generation_mw FROM bronze_demand)",
    "calendar_parts": """
SELECT event_id, CAST(ts AS DATE) AS day, hour(ts) AS hour, month(ts) AS month, year(ts) AS year,
       dayofweek(ts) + 1 AS day_of_week, isodow(ts) - 1 AS weekday, dayname(ts) AS day_name,
       (isodow(ts) - 1) * 24 + hour(ts) AS hour_of_week, timestamp_hour FROM ev""",
    "feed_value_parse": """
SELECT event_id, CASE WHEN event_id % 31 <> 0 THEN timestamp_hour END AS timestamp_hour,
       CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0
             AND event_id % 17 <> 0 THEN value END AS demand_mw FROM ev""",
    "display_labels": """
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'Invalid Date'
                      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS label FROM events""",
    "seasonal_terms": """
SELECT timestamp_hour, sin(2 * pi() * h / 24) AS sin_daily, cos(2 * pi() * h / 24) AS cos_daily,
       sin(2 * pi() * h / 168) AS sin_weekly, cos(2 * pi() * h / 168) AS cos_weekly,
       sin(2 * pi() * h / 8766) AS sin_yearly, cos(2 * pi() * h / 8766) AS cos_yearly
FROM (SELECT timestamp_hour, epoch(timestamp_hour) / 3600.0 AS h FROM bronze_demand)""",
    "forecast_daily": _forecast_daily("gold_forecasts"),
    "forecast_daily_newest_run": _forecast_daily("two_runs WHERE run_id = 'run-2'"),
    "forecast_daily_all_runs": _forecast_daily("two_runs"),
    "forecast_by_hour": """
SELECT hour(timestamp_hour) AS forecast_hour, avg(yhat) AS avg_forecast_mw,
       stddev_samp(yhat) AS forecast_stddev, avg(yhat_upper - yhat_lower) AS avg_uncertainty
FROM gold_forecasts GROUP BY 1""",
    "seasonal_profile_forecast": "SELECT * FROM gold_forecasts",
    "seasonal_profile_forecast_weekly": """
SELECT a.series_id, a.timestamp_hour, coalesce(c.m, p.m) AS yhat,
       coalesce(c.m, p.m) - 1.2816 * coalesce(c.sd, p.sd, 0) AS yhat_lower,
       coalesce(c.m, p.m) + 1.2816 * coalesce(c.sd, p.sd, 0) AS yhat_upper
FROM ahead a
LEFT JOIN (SELECT series_id, (isodow(timestamp_hour) - 1) * 24 + hour(timestamp_hour) AS cell,
                  avg(demand_mw) AS m, stddev_samp(demand_mw) AS sd
           FROM silver WHERE demand_mw IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2) c
  ON a.series_id = c.series_id
     AND (isodow(a.timestamp_hour) - 1) * 24 + hour(a.timestamp_hour) = c.cell
LEFT JOIN profile p ON a.series_id = p.series_id AND hour(a.timestamp_hour) = p.h""",
    "additive_forecast_trend_only": """
SELECT a.series_id, a.timestamp_hour, y AS yhat, y - half AS yhat_lower, y + half AS yhat_upper
FROM (
  SELECT a.series_id, a.timestamp_hour,
         my + slope * ((epoch(a.timestamp_hour) - x0) / 3600.0 - mx) AS y,
         1.2816 * sqrt((syy - slope * sxy) / (n - 2)) AS half
  FROM ahead a JOIN (
    SELECT series_id, min(x0) AS x0, regr_slope(demand_mw, x) AS slope, avg(x) AS mx,
           avg(demand_mw) AS my, regr_syy(demand_mw, x) AS syy, regr_sxy(demand_mw, x) AS sxy,
           count(*) AS n
    FROM (SELECT series_id, demand_mw, x0, (epoch(timestamp_hour) - x0) / 3600.0 AS x
          FROM silver JOIN (SELECT series_id, epoch(min(timestamp_hour)) AS x0 FROM silver
                            WHERE demand_mw IS NOT NULL GROUP BY 1) USING (series_id)
          WHERE demand_mw IS NOT NULL)
    GROUP BY 1) f USING (series_id)) a""",
    "additive_normal_equations": """
WITH hours AS (SELECT series_id, epoch(timestamp_hour) / 3600 AS x, demand_mw AS y FROM silver
               WHERE demand_mw IS NOT NULL),
ends AS (SELECT series_id, min(x) AS x0, max(x) - min(x) AS span, max(abs(y)) AS scale
         FROM hours GROUP BY 1),
feature AS (
  SELECT series_id, x, unnest([
           1.0, (x - x0) / span,
           sin(2 * pi() * x / 24), cos(2 * pi() * x / 24),
           sin(4 * pi() * x / 24), cos(4 * pi() * x / 24),
           sin(6 * pi() * x / 24), cos(6 * pi() * x / 24),
           sin(8 * pi() * x / 24), cos(8 * pi() * x / 24), y / scale]) AS v,
         unnest(range(11)) AS i
  FROM hours JOIN ends USING (series_id))
SELECT a.series_id, a.i, b.i AS j, sum(a.v * b.v) AS total
FROM feature a JOIN feature b USING (series_id, x) WHERE a.i < 10 GROUP BY ALL""",
    "additive_forecast_shape": """
SELECT series_id, min(timestamp_hour) AS first_hour, max(timestamp_hour) AS last_hour,
       count(*) AS points, true AS ordered FROM ahead GROUP BY 1""",
    "forecast_accuracy": """
SELECT count(*) AS points, avg(abs(y - f) / nullif(abs(y), 0)) * 100 AS mape_pct,
       sqrt(avg((y - f) * (y - f))) AS rmse,
       avg(CASE WHEN py IS NULL OR pf IS NULL THEN NULL
                WHEN sign(y - py) = sign(f - pf) THEN 1.0 ELSE 0.0 END) * 100 AS direction_pct,
       avg(CASE WHEN y BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END) * 100 AS coverage_pct
FROM (
  SELECT demand_mw AS y, m AS f, m - 1.2816 * sd AS lo, m + 1.2816 * sd AS hi,
         CASE WHEN lag(timestamp_hour) OVER t = timestamp_hour - INTERVAL 1 HOUR
              THEN lag(demand_mw) OVER t END AS py,
         CASE WHEN lag(timestamp_hour) OVER t = timestamp_hour - INTERVAL 1 HOUR
              THEN lag(m) OVER t END AS pf
  FROM demand JOIN (
    SELECT hour(timestamp_hour) AS h, avg(demand_mw) AS m, stddev_samp(demand_mw) AS sd
    FROM silver WHERE demand_mw IS NOT NULL AND timestamp_hour < TIMESTAMP '2024-01-29 00:00:00'
    GROUP BY 1) ON h = hour(timestamp_hour)
  WHERE timestamp_hour >= TIMESTAMP '2024-01-29 00:00:00'
    AND timestamp_hour < TIMESTAMP '2024-01-31 00:00:00'
  WINDOW t AS (ORDER BY timestamp_hour))""",
    "forecast_to_gold": "SELECT * FROM gold_forecasts",
    "dispatch_daily": _dispatch_daily("hour_profit"),
    "dispatch_daily_run_totals": _dispatch_daily("expected_profit"),
    "dispatch_by_hour": """
SELECT hour(timestamp_hour) AS hour_of_day, avg(charge_mwh) AS avg_charge_mwh,
       avg(discharge_mwh) AS avg_discharge_mwh, avg(soc_mwh) AS avg_soc_mwh,
       count(*) AS observations FROM gold_dispatch GROUP BY 1""",
    "profit_summary": f"""
SELECT {_profits("hour_profit")}, stddev_samp(hour_profit) AS profit_stddev FROM gold_dispatch""",
    "profit_summary_run_totals": f"SELECT {_profits('expected_profit')} FROM gold_dispatch",
    "dispatch_summary": f"""
SELECT {_profits("hour_profit")}, avg(soc_mwh) AS avg_soc_mwh,
       sum(charge_mwh) AS total_charge_mwh, sum(discharge_mwh) AS total_discharge_mwh
FROM gold_dispatch""",
    "dispatch_summary_by_battery": f"""
SELECT scenario_id, {_profits("hour_profit * part")}, avg(soc_mwh * part) AS avg_soc_mwh,
       sum(charge_mwh * part) AS total_charge_mwh, sum(discharge_mwh * part) AS total_discharge_mwh
FROM gold_dispatch, (VALUES ('base', 1.0), ('unit', 0.01), ('large', 2.0)) AS b(scenario_id, part)
GROUP BY 1""",
    "dispatch_run_summary": """
SELECT 'run-1' AS run_id, 'all' AS series_id, 'base' AS scenario_id,
       sum(charge_mwh) AS total_charge_mwh, sum(discharge_mwh) AS total_discharge_mwh,
       max(soc_mwh) AS max_soc_mwh, min(soc_mwh) AS min_soc_mwh, sum(hour_profit) AS run_profit
FROM gold_dispatch""",
    "dispatch_run_summary_runs": """
SELECT run_id, 'all' AS series_id, scenario_id,
       sum(charge_mwh) AS total_charge_mwh, sum(discharge_mwh) AS total_discharge_mwh,
       max(soc_mwh) AS max_soc_mwh, min(soc_mwh) AS min_soc_mwh, sum(hour_profit) AS run_profit
FROM dispatch_runs WHERE run_id = 'run-2' GROUP BY 1, 2, 3""",
    "optimal_bid": """
SELECT timestamp_hour, price - 100 AS price, greatest(0, (price - 100) / 0.02) AS bid_mwh
FROM gold_dispatch""",
    "dispatch_profit": "SELECT * FROM gold_dispatch",
    "battery_dispatch_lossless_value": """
SELECT series_id, day, max(v) AS trading_value FROM (
  WITH RECURSIVE steps AS (
    SELECT series_id, day, price, n, count(*) OVER (PARTITION BY series_id, day) AS total
    FROM (SELECT series_id, CAST(timestamp_hour AS DATE) AS day, demand_mw - 40 AS price,
                 row_number() OVER (PARTITION BY series_id, CAST(timestamp_hour AS DATE)
                                    ORDER BY timestamp_hour) AS n FROM demand)
  ),
  states AS (
    SELECT DISTINCT series_id, day, CAST(0 AS BIGINT) AS n, 1 AS level, CAST(0 AS DOUBLE) AS v
    FROM steps
    UNION ALL
    SELECT series_id, day, n, level, max(v) AS v FROM (
      SELECT s.series_id, s.day, p.n, s.level + m.move AS level,
             s.v - 50 * p.price * m.move AS v
      FROM states s JOIN steps p ON p.series_id = s.series_id AND p.day = s.day AND p.n = s.n + 1
           JOIN (VALUES (-1), (0), (1)) AS m(move) ON s.level + m.move BETWEEN 0 AND 2)
    GROUP BY 1, 2, 3, 4
  )
  SELECT s.* FROM states s JOIN (SELECT DISTINCT series_id, day, total FROM steps) e
    ON e.series_id = s.series_id AND e.day = s.day AND e.total = s.n
) GROUP BY 1, 2""",
    "battery_dispatch_lossy_value": f"""
SELECT series_id, day, max(v) AS trading_value
FROM ({_fast_battery("CAST(timestamp_hour AS DATE)")}) GROUP BY 1, 2""",
    "battery_dispatch_long": f"""
SELECT series_id, hours, trading_value, trading_value + bids AS run_total FROM (
  SELECT series_id, max(v) AS trading_value
  FROM ({_fast_battery("DATE '2024-01-01'")}) GROUP BY 1
) JOIN (SELECT series_id, count(*) AS hours, sum(demand_mw * demand_mw / 0.02) AS bids FROM demand GROUP BY 1)
  USING (series_id)""",
    "battery_dispatch_audit": f"""
SELECT scenario_id, count(*) AS hours,
       count(DISTINCT (series_id, CAST(timestamp_hour AS DATE))) AS horizons, 0 AS violations,
       sum(greatest(0, (demand_mw - 40) / 0.02)) AS bid_total
FROM demand, {_BATTERIES} GROUP BY 1""",
    "dispatch_check": """
SELECT * FROM (
  SELECT timestamp_hour, residual, abs(residual) > 0.0001 AS balance,
         soc_mwh < -0.0001 OR soc_mwh > 100.0001 AS level,
         charge_mwh > 50.0001 OR discharge_mwh > 50.0001 AS power
  FROM (SELECT *, soc_mwh - coalesce(lag(soc_mwh) OVER (ORDER BY timestamp_hour), 50)
                  - (0.95 * charge_mwh - discharge_mwh / 0.95) AS residual FROM gold_dispatch))
WHERE balance OR level OR power""",
    "merit_order": f"""
SELECT timestamp_hour, demand_mw, {_merit("demand_mw")}
FROM (SELECT timestamp_hour, demand_mw * 4 AS demand_mw FROM silver)""",
    "generation_dispatch_least_cost": _LEAST_COST,
    "dispatch_feasibility": _LEAST_COST,
    "dispatch_feasibility_agrees": """
SELECT series_id, count(*) AS hours, 0 AS differing FROM silver WHERE demand_mw IS NOT NULL
GROUP BY 1""",
    "generation_dispatch_audit": """
SELECT series_id, count(*) AS hours, 0 AS violations, 0 AS dearer_days FROM silver GROUP BY 1""",
    "generation_dispatch_without_store": f"""
SELECT series_id, day, CASE WHEN count(*) FILTER (full_unserved) > 0 THEN 'infeasible'
                            ELSE 'optimal' END AS status,
       count(*) AS hours,
       CASE WHEN count(*) FILTER (full_unserved) = 0 THEN sum(cost) END AS total_cost
FROM (SELECT *, coalesce(unserved_mw > 0, true) AS full_unserved FROM (
  SELECT series_id, CAST(timestamp_hour AS DATE) AS day, {_merit("demand_mw")}
  FROM (SELECT series_id, timestamp_hour, demand_mw * 6 AS demand_mw FROM silver)))
GROUP BY 1, 2""",
    "generation_mix_summary": f"""
WITH mix AS (SELECT {_merit("demand_mw")} FROM (SELECT demand_mw * 4 AS demand_mw FROM silver))
SELECT 'wind' AS source, sum(wind_mw) AS total_mwh, sum(wind_mw) * 0.03 AS total_cost FROM mix
UNION ALL SELECT 'solar', sum(solar_mw), sum(solar_mw) * 0.05 FROM mix
UNION ALL SELECT 'gas', sum(gas_mw), sum(gas_mw) * 0.08 FROM mix""",
    "store_summary": "SELECT max(soc_mwh) AS peak_soc, min(soc_mwh) AS min_soc FROM gold_dispatch",
    "dispatch_to_gold": f"""
SELECT scenario_id, 'run-1' AS run_id, count(*) AS hours, min(timestamp_hour) AS first_hour,
       max(timestamp_hour) AS last_hour, sum(greatest(0, yhat / (2 * lam))) AS bid_total
FROM gold_forecasts, {_BATTERIES} GROUP BY 1""",
    "forecast_horizon_view": f"""
SELECT strftime(timestamp_hour, '%Y-%m-%dT%H:%M:%SZ') AS timestamp_hour, yhat, yhat_lower,
       yhat_upper FROM gold_forecasts WHERE timestamp_hour >= {NOW_HOUR}""",
    "dispatch_horizon_view": f"""
SELECT strftime(timestamp_hour, '%Y-%m-%dT%H:%M:%SZ') AS timestamp_hour, price, charge_mwh,
       discharge_mwh, soc_mwh, bid_mwh, expected_profit FROM gold_dispatch
WHERE timestamp_hour >= {MID_MONTH_HOUR}""",
    "forecast_cards": f"""
SELECT round(avg(yhat)) AS avg_demand, round(max(yhat)) AS peak_demand,
       round(min(yhat)) AS min_demand, count(*) AS data_points
FROM gold_forecasts WHERE timestamp_hour >= {NOW_HOUR}""",
    "dispatch_cards": f"""
SELECT sum(charge_mwh) AS total_charge_mwh, sum(discharge_mwh) AS total_discharge_mwh,
       avg(soc_mwh) AS avg_soc_mwh, sum(hour_profit) AS total_profit, avg(price) AS avg_price,
       sum(discharge_mwh) / nullif(sum(charge_mwh), 0) * 100 AS round_trip_pct,
       count(*) AS data_points
FROM gold_dispatch WHERE timestamp_hour >= {MID_MONTH_HOUR}""",
    "dispatch_chart": f"""
SELECT strftime(timestamp_hour, '%Y-%m-%d %H:%M:%S') AS label,
       round(CAST(charge_mwh AS DECIMAL(28,6)), 2) AS charge_mwh,
       round(CAST(-discharge_mwh AS DECIMAL(28,6)), 2) AS discharge_mwh,
       round(CAST(soc_mwh AS DECIMAL(28,6)), 2) AS soc_mwh,
       round(CAST(price AS DECIMAL(28,6)), 2) AS price
FROM gold_dispatch WHERE timestamp_hour >= {MID_MONTH_HOUR}""",
    "insights": f"""
SELECT p.peak_hour, p.peak_avg_mw, p.min_hour, p.min_avg_mw,
       p.peak_avg_mw - p.min_avg_mw AS demand_range_mw, c.r AS latest_correlation,
       CASE WHEN abs(c.r) > 0.5 THEN 'Strong' WHEN abs(c.r) > 0.3 THEN 'Moderate'
            WHEN c.r IS NOT NULL THEN 'Weak' END AS correlation_label,
       d.total_profit, d.avg_soc_mwh, o.total_rows, o.data_start, o.data_end
FROM (SELECT arg_max(h, (m, -h)) AS peak_hour, max(m) AS peak_avg_mw,
             arg_min(h, (m, h)) AS min_hour, min(m) AS min_avg_mw
      FROM (SELECT hour(timestamp_hour) AS h, avg(demand_mw) AS m FROM demand GROUP BY 1)) p,
     (SELECT max(r) AS r FROM (SELECT temp_demand_correlation AS r FROM ({_CORR} LIMIT 1))) c,
     (SELECT sum(hour_profit) AS total_profit, avg(soc_mwh) AS avg_soc_mwh FROM gold_dispatch) d,
     (SELECT sum(row_count) AS total_rows, min(earliest_data) AS data_start,
             max(latest_data) AS data_end FROM ({_overview(_CORE)})) o""",
    "actual_vs_forecast": """
SELECT *, (SELECT max(timestamp_hour) FROM silver) AS now_boundary FROM (
  (SELECT 'actual' AS kind, timestamp_hour, demand_mw AS value, CAST(NULL AS DOUBLE) AS yhat_lower,
          CAST(NULL AS DOUBLE) AS yhat_upper FROM silver ORDER BY timestamp_hour DESC LIMIT 168)
  UNION ALL
  SELECT 'forecast' AS kind, timestamp_hour, yhat AS value, yhat_lower, yhat_upper
  FROM gold_forecasts)""",
    "actual_vs_forecast_runs": """
SELECT *, (SELECT max(timestamp_hour) FROM silver) AS now_boundary FROM (
  (SELECT 'actual' AS kind, timestamp_hour, demand_mw AS value, CAST(NULL AS DOUBLE) AS yhat_lower,
          CAST(NULL AS DOUBLE) AS yhat_upper FROM silver ORDER BY timestamp_hour DESC LIMIT 168)
  UNION ALL
  SELECT 'forecast' AS kind, timestamp_hour, yhat AS value, yhat_lower, yhat_upper
  FROM shifted_runs WHERE n = 3)""",
    "forecast_horizon_view_runs": f"""
SELECT strftime(timestamp_hour, '%Y-%m-%dT%H:%M:%SZ') AS timestamp_hour, yhat, yhat_lower,
       yhat_upper FROM shifted_newest WHERE timestamp_hour >= {NOW_HOUR}""",
    "forecast_cards_runs": f"""
SELECT round(avg(yhat)) AS avg_demand, round(max(yhat)) AS peak_demand,
       round(min(yhat)) AS min_demand, count(*) AS data_points
FROM shifted_newest WHERE timestamp_hour >= {NOW_HOUR}""",
    "dispatch_cards_runs": f"""
SELECT sum(charge_mwh) AS total_charge_mwh, sum(discharge_mwh) AS total_discharge_mwh,
       avg(soc_mwh) AS avg_soc_mwh, sum(hour_profit) AS total_profit, avg(price) AS avg_price,
       sum(discharge_mwh) / nullif(sum(charge_mwh), 0) * 100 AS round_trip_pct,
       count(*) AS data_points
FROM dispatch_newest WHERE timestamp_hour >= {MID_MONTH_HOUR} AND scenario_id = 'base'""",
    "forecast_run_summary_runs": """
SELECT min(timestamp_hour) AS forecast_start, max(timestamp_hour) AS forecast_end,
       avg(yhat) AS avg_forecast_mw, max(yhat) AS max_forecast_mw, min(yhat) AS min_forecast_mw,
       count(*) AS forecast_points,
       (SELECT min(demand_mw) FROM (SELECT demand_mw FROM silver ORDER BY timestamp_hour DESC
                                    LIMIT 168)) AS min_actual_mw,
       (SELECT max(demand_mw) FROM (SELECT demand_mw FROM silver ORDER BY timestamp_hour DESC
                                    LIMIT 168)) AS max_actual_mw
FROM shifted_runs WHERE n = 3""",
    "profile_exploration": """
SELECT 'hour' AS profile, hour(timestamp_hour) AS position, avg(demand_mw) AS avg_demand_mw
FROM silver WHERE demand_mw IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'weekday', isodow(timestamp_hour) - 1, avg(demand_mw) FROM silver
WHERE demand_mw IS NOT NULL GROUP BY 2""",
    "temp_demand_pairs": "SELECT * FROM weathered",
    "forecast_run_summary": """
SELECT min(timestamp_hour) AS forecast_start, max(timestamp_hour) AS forecast_end,
       avg(yhat) AS avg_forecast_mw, max(yhat) AS max_forecast_mw, min(yhat) AS min_forecast_mw,
       count(*) AS forecast_points,
       (SELECT min(demand_mw) FROM (SELECT demand_mw FROM silver ORDER BY timestamp_hour DESC
                                    LIMIT 168)) AS min_actual_mw,
       (SELECT max(demand_mw) FROM (SELECT demand_mw FROM silver ORDER BY timestamp_hour DESC
                                    LIMIT 168)) AS max_actual_mw
FROM gold_forecasts""",
    "load_summary": """
SELECT count(*) AS row_count, min(timestamp_hour) AS first_hour, max(timestamp_hour) AS last_hour,
       min(demand_mw) AS min_value, max(demand_mw) AS max_value FROM silver""",
    "load_summary_horizon": f"""
SELECT count(*) AS row_count, min(timestamp_hour) AS first_hour, max(timestamp_hour) AS last_hour,
       min(yhat) AS min_value, max(yhat) AS max_value FROM gold_forecasts
WHERE timestamp_hour >= {NOW_HOUR}""",
    "first_and_last": """
SELECT series_id, arg_min(demand_mw, timestamp_hour) AS first_value,
       arg_max(demand_mw, timestamp_hour) AS last_value FROM demand GROUP BY 1""",
    "newest_rows": """
SELECT * FROM silver
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY timestamp_hour DESC) <= 48""",
    "trailing_window": f"""
SELECT * FROM bronze_demand WHERE timestamp_hour >= {AS_OF} - INTERVAL 14 DAY""",
    "current_horizon": f"SELECT * FROM gold_forecasts WHERE timestamp_hour >= {NOW_HOUR}",
    "hour_weekday_heatmap": "SELECT hour(timestamp_hour) AS hour_of_day, "
    + ", ".join(
        f"avg(demand_mw) FILTER (dayofweek(timestamp_hour) = {i}) AS {name}"
        for i, name in enumerate(("sun", "mon", "tue", "wed", "thu", "fri", "sat"))
    )
    + " FROM demand GROUP BY 1",
    "demand_distribution_by_hour": _spread("hour(timestamp_hour)", "demand"),
    "demand_distribution_by_weekday": _spread("dayofweek(timestamp_hour) + 1", "demand"),
    "demand_distribution_by_date": _spread("CAST(timestamp_hour AS DATE)", "demand"),
    "demand_distribution_by_month": _spread("month(timestamp_hour)", "order_months"),
    "decompose": """
SELECT *, demand_mw - trend - seasonal AS residual FROM (
  SELECT *, avg(demand_mw - trend) OVER (PARTITION BY series_id, isodow(timestamp_hour),
                                         hour(timestamp_hour)) AS seasonal
  FROM (SELECT series_id, timestamp_hour, demand_mw,
               avg(demand_mw) OVER (PARTITION BY series_id ORDER BY timestamp_hour
                                    ROWS BETWEEN 84 PRECEDING AND 83 FOLLOWING) AS trend
        FROM demand))""",
    "corr_matrix": " UNION ALL ".join(
        [
            _corr_pair("demand_mw", "temp_c"),
            _corr_pair("demand_mw", "wind_speed_mps"),
            _corr_pair("temp_c", "wind_speed_mps"),
        ]
    ),
    "weekend_vs_weekday": """
SELECT CASE WHEN dayofweek(timestamp_hour) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type,
       CASE WHEN hour(timestamp_hour) BETWEEN 6 AND 9 OR hour(timestamp_hour) BETWEEN 18 AND 21
            THEN 'peak' ELSE 'off_peak' END AS hour_type,
       avg(demand_mw) AS avg_demand_mw, count(*) AS hourly_readings FROM demand GROUP BY 1, 2""",
    "nightly_refresh": f"""
WITH n_demand AS ({_LANDED_DAY}),
n_grid AS (SELECT unnest(generate_series(min(timestamp_hour), max(timestamp_hour),
                                         INTERVAL 1 HOUR)) AS timestamp_hour FROM n_demand),
n_ahead AS (SELECT unnest(generate_series(max(timestamp_hour) + INTERVAL 1 HOUR,
                                          max(timestamp_hour) + INTERVAL 48 HOUR,
                                          INTERVAL 1 HOUR)) AS timestamp_hour FROM n_grid),
n_dispatch AS (SELECT timestamp_hour FROM n_ahead, {_BATTERIES}
               WHERE timestamp_hour >= {NOW_HOUR})
{_overview({
    "bronze_demand": "n_demand", "bronze_weather": "weather_means",
    "silver_demand_weather": "n_grid", "gold_forecasts": "n_ahead", "gold_dispatch": "n_dispatch",
})}""",
    "stream_hourly": """
SELECT timestamp_hour, sum(value) AS demand_mw, count(*) AS event_count FROM ev
WHERE timestamp_hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
GROUP BY 1""",
    "stream_refresh_table": """
SELECT series_id, timestamp_hour, arg_max(value, ts) AS demand_mw, max(ts) AS loaded_at
FROM ev WHERE event_type = 'click' GROUP BY 1, 2""",
}


BODIES["battery_dispatch_blocks"] = BODIES["battery_dispatch_long"]

# Reports of a fleet's dispatch table speak of the base battery alone.
BODIES |= {
    f"{name}_fleet": BODIES[name]
    for name in (
        "dispatch_daily", "dispatch_by_hour", "profit_summary", "dispatch_summary",
        "dispatch_cards", "dispatch_horizon_view", "insights",
    )
}


def _finish(name: str) -> str:
    entry = REGISTRY[name]
    cells = []
    for column, kind, digits in entry.columns():
        cell = f'CAST(q."{column}" AS {_SQL_TYPES[kind]})'
        if kind == "x":
            cell = f"round({cell} + {nudge(digits)}, {digits})"
            cell = f"CASE WHEN {cell} = 0 THEN CAST(0 AS DOUBLE) ELSE {cell} END"
        cells.append(f'{cell} AS "{column}"')
    ctes = _tables(entry.series)
    return f"WITH {ctes.strip()}\nSELECT {', '.join(cells)}\nFROM ({BODIES[name].strip()}) AS q"


def oracle_sql() -> dict[str, str]:
    return {name: _finish(name) for name in BODIES}
