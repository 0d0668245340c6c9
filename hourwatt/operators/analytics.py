"""The catalogue of analytics queries.

Each takes the mapping of tables. ``by`` adds grouping columns such as ``series_id``; ``limit``
defaults to the length of the published report, ``None`` gives all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourwatt.functions import numbers as N
from hourwatt.functions import times as TM
from hourwatt.operators.frames import moving_means
from hourwatt.operators.grid import HOUR
from hourwatt.operators.keys import latest_per_key, newest_rows, top

Tables = Mapping[str, DataFrame]

CORE_TABLES = ("bronze_demand", "bronze_weather", "silver_demand_weather")
ALL_TABLES = (*CORE_TABLES, "gold_forecasts", "gold_dispatch")
FULL_DAY = 20  # fixed value: readings that make a day count as complete
OUTLIER_Z = 3.0  # fixed value
DAY_ROWS, WEEK_ROWS, MONTH_ROWS = 24, 168, 720
BASE_BATTERY = "base"  # the battery that reports speak of unless told otherwise
RUN_ORDER = ("created_at", "run_id")
SERIES = ("series_id",)


def _known(df: DataFrame) -> DataFrame:
    return df.where(F.col("demand_mw").isNotNull())


def known_demand(tables: Tables) -> DataFrame:
    return _known(tables["bronze_demand"])


def _with_weather(df: DataFrame) -> DataFrame:
    return df.where(F.col("temp_c").isNotNull() & F.col("demand_mw").isNotNull())


def _weathered(tables: Tables) -> DataFrame:
    return _with_weather(tables["silver_demand_weather"])


def newest_days(
    tables: Tables,
    name: str,
    report: Callable[[DataFrame], DataFrame],
    order: Sequence[Column | str],
    limit: int | None,
) -> DataFrame:
    """The first ``limit`` rows of a report by day, newest day first, from the newest days alone.

    Stored tables list their days. As many newest ones are read as the report has rows to show, twice as
    many as long as those do not give enough of them; a table that lists no days is read whole.
    """
    listed = getattr(tables, "days", None)
    days = listed(name) if listed and limit else []
    width = limit or 0
    while width < len(days):
        found = report(tables[name].where(F.col("event_date") >= F.lit(days[width - 1])))
        if found.limit(limit).count() == limit:
            return top(found, order, limit)
        width *= 2
    return top(report(tables[name]), order, limit)


def newest_run(df: DataFrame) -> DataFrame:
    """Forecast or dispatch rows of the newest run for each hour."""
    keys = [c for c in ("series_id", "scenario_id", HOUR) if c in df.columns]
    return latest_per_key(df, keys, [c for c in RUN_ORDER if c in df.columns])


def one_run(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows of one run: the named one, or the newest (a run without ``created_at`` is the oldest)."""
    if run_id is not None:
        return df.where(F.col("run_id") == run_id)
    newest = df.agg(F.max(F.struct(*RUN_ORDER)).alias("run")).select("run.run_id").scalar()
    return df.where(F.col("run_id").eqNullSafe(newest))


def forecasts(tables: Tables, all_runs: bool = False) -> DataFrame:
    df = tables["gold_forecasts"]
    return df if all_runs else newest_run(df)


def one_battery(df: DataFrame, battery: str | None) -> DataFrame:
    """Dispatch rows of one battery. Those of one price path are alternatives, so totals over several
    mean nothing; ``None`` takes all, for reports grouped by ``scenario_id``."""
    return df if battery is None else df.where(F.col("scenario_id") == battery)


def dispatch(
    tables: Tables, all_runs: bool = False, battery: str | None = BASE_BATTERY
) -> DataFrame:
    df = one_battery(tables["gold_dispatch"], battery)
    return df if all_runs else newest_run(df)


def profit_column(faithful: bool) -> str:
    """``expected_profit`` repeats the run total on every row; summing it counts it per hour."""
    return "expected_profit" if faithful else "hour_profit"


def _demand_stats(prefix: str = "{}_demand_mw") -> list[Column]:
    return [
        fn("demand_mw").alias(prefix.format(name))
        for name, fn in (("avg", F.avg), ("min", F.min), ("max", F.max))
    ]


def _date(column: str = HOUR) -> Column:
    return F.to_date(column)


# overview and data quality ------------------------------------------------------------------


def table_overview(tables: Tables, names: Sequence[str] = ALL_TABLES) -> DataFrame:
    """Rows, first and last hour and number of days of each table.

    One pass counts per table and day; the second step sees one row per table and day only.
    """
    parts = [tables[n].select(F.lit(n).alias("table_name"), F.col(HOUR)) for n in names]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    days = rows.groupBy("table_name", _date().alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(HOUR).alias("_min"), F.max(HOUR).alias("_max")
    )
    return (
        days.groupBy("table_name")
        .agg(
            F.sum("_n").alias("row_count"),
            F.min("_min").alias("earliest_data"),
            F.max("_max").alias("latest_data"),
            F.count("_day").alias("unique_days"),
        )
        .orderBy("table_name")
    )


def _missing(df: DataFrame, name: str, column: str, alias: str) -> DataFrame:
    total, present = F.count(F.lit(1)), F.count(column)
    return df.agg(
        F.lit(name).alias("table_name"),
        total.alias("total_rows"),
        present.alias(f"non_null_{alias}"),
        (total - present).alias(f"missing_{alias}"),
        N.percent(total - present, total, 2).alias("missing_pct"),
    )


def missing_data(tables: Tables) -> DataFrame:
    """Missing demand and missing temperature; the union is by position."""
    demand = _missing(tables["bronze_demand"], "bronze_demand", "demand_mw", "demand")
    weather = _missing(tables["bronze_weather"], "bronze_weather", "temp_c", "temp")
    return demand.union(weather).orderBy("table_name")


def demand_outliers(
    tables: Tables, *, by: Sequence[str] = (), limit: int | None = 20
) -> DataFrame:
    """Readings more than three standard deviations from the mean (of all rows or per group)."""
    df = known_demand(tables)
    mean, sd = F.avg("demand_mw"), F.stddev_samp("demand_mw")
    if by:
        stats = df.groupBy(*by).agg(mean.alias("_mean"), sd.alias("_sd"))
        scored = df.join(stats, list(by)).withColumn(
            "z_score", N.z_score(F.col("demand_mw"), F.col("_mean"), F.col("_sd"))
        )
    else:
        scored = df.withColumn(
            "z_score",
            N.z_score(F.col("demand_mw"), df.select(mean).scalar(), df.select(sd).scalar()),
        )
    found = scored.where(F.col("z_score") > OUTLIER_Z)
    return top(found.select(*by, HOUR, "demand_mw", "z_score"), [F.desc("z_score"), HOUR], limit)


# demand -------------------------------------------------------------------------------------


def daily_demand(tables: Tables, *, by: Sequence[str] = (), limit: int | None = 30) -> DataFrame:
    def days(df: DataFrame) -> DataFrame:
        return _known(df).groupBy(*by, _date().alias("date")).agg(
            *_demand_stats(),
            F.stddev_samp("demand_mw").alias("demand_stddev"),
            F.count(F.lit(1)).alias("hourly_readings"),
        )

    return newest_days(tables, "bronze_demand", days, [F.desc("date"), *by], limit)


def hourly_profile(tables: Tables, *, by: Sequence[str] = ()) -> DataFrame:
    hours = known_demand(tables).groupBy(*by, F.hour(HOUR).alias("hour_of_day")).agg(
        *_demand_stats(), F.count(F.lit(1)).alias("sample_count")
    )
    return hours.orderBy(*by, "hour_of_day")


def weekday_profile(tables: Tables, *, by: Sequence[str] = ()) -> DataFrame:
    ts = F.col(HOUR)
    days = known_demand(tables).groupBy(
        *by, TM.day_of_week(ts).alias("day_of_week"), TM.day_name(ts).alias("day_name")
    )
    return days.agg(*_demand_stats()).orderBy(*by, "day_of_week")


def monthly_demand(tables: Tables, *, by: Sequence[str] = ()) -> DataFrame:
    months = known_demand(tables).groupBy(
        *by, F.month(HOUR).alias("month"), F.year(HOUR).alias("year")
    )
    counted = months.agg(*_demand_stats(), F.count(F.lit(1)).alias("hourly_readings"))
    return counted.orderBy(*by, "year", "month")


def monthly_seasonality(tables: Tables, *, by: Sequence[str] = ()) -> DataFrame:
    months = known_demand(tables).groupBy(*by, F.month(HOUR).alias("month"))
    counted = months.agg(*_demand_stats("seasonal_{}"), F.count(F.lit(1)).alias("sample_size"))
    return counted.orderBy(*by, "month")


def mom_growth(tables: Tables, *, by: Sequence[str] = ()) -> DataFrame:
    """Month averages beside the previous month that has data; one row per month is windowed."""
    months = known_demand(tables).groupBy(
        *by, F.year(HOUR).alias("year"), F.month(HOUR).alias("month")
    ).agg(F.avg("demand_mw").alias("avg_demand_mw"))
    before = F.lag("avg_demand_mw").over(Window.partitionBy(*by).orderBy("year", "month"))
    return (
        months.withColumn("prev_month_avg", before)
        .withColumn("month_over_month_change", F.col("avg_demand_mw") - F.col("prev_month_avg"))
        .orderBy(*by, "year", "month")
    )


def peak_days(tables: Tables, *, by: Sequence[str] = (), limit: int | None = 20) -> DataFrame:
    """Daily maximum and the earliest hour that reached it.

    Hours are reduced to their maximum first, so the second step sees at most 24 rows per day.
    """
    hours = known_demand(tables).groupBy(
        *by, _date().alias("date"), F.hour(HOUR).alias("_hour")
    ).agg(F.max("demand_mw").alias("_peak"))
    best = F.max(F.struct("_peak", (-F.col("_hour")).alias("_before")))
    days = hours.groupBy(*by, "date").agg(best.alias("_best"))
    out = days.select(
        *by,
        "date",
        F.col("_best._peak").alias("peak_demand_mw"),
        (-F.col("_best._before")).alias("peak_hour"),
    )
    return top(out, [F.desc("peak_demand_mw"), "date", *by], limit)


def volatility_days(
    tables: Tables, *, by: Sequence[str] = (), limit: int | None = 20
) -> DataFrame:
    days = known_demand(tables).groupBy(*by, _date().alias("date")).agg(
        F.min("demand_mw").alias("min_demand"),
        F.max("demand_mw").alias("max_demand"),
        (F.max("demand_mw") - F.min("demand_mw")).alias("daily_range"),
        F.stddev_samp("demand_mw").alias("daily_volatility"),
        F.count(F.lit(1)).alias("hourly_readings"),
    )
    full = days.where(F.col("hourly_readings") >= FULL_DAY)
    return top(full, [F.desc("daily_range"), "date", *by], limit)


def efficiency_daily(
    tables: Tables, *, by: Sequence[str] = (), limit: int | None = 30
) -> DataFrame:
    def days(df: DataFrame) -> DataFrame:
        both = _known(df).where(F.col("generation_mw").isNotNull())
        return both.groupBy(*by, _date().alias("date")).agg(
            F.avg("demand_mw").alias("avg_demand"),
            F.avg("generation_mw").alias("avg_generation"),
            F.try_divide(F.avg("generation_mw"), F.avg("demand_mw")).alias("efficiency_ratio"),
            F.count(F.lit(1)).alias("hourly_readings"),
        )

    return newest_days(tables, "bronze_demand", days, [F.desc("date"), *by], limit)


def trailing_means(
    df: DataFrame, windows: Mapping[str, int], *, by: Sequence[str] = SERIES
) -> DataFrame:
    """Means over the last ``n`` readings, gaps not counted, for every row."""
    return moving_means(df, "demand_mw", {name: (1 - n, 0) for name, n in windows.items()}, by)


def rolling_averages(
    tables: Tables,
    *,
    by: Sequence[str] = SERIES,
    limit: int | None = 100,
    days30: bool = False,
) -> DataFrame:
    """Trailing 24, 168 and on request 720 row means, newest rows first.

    With a limit only the newest rows (of each group), and the rows their frames reach, leave the
    scan; the frames then run over that fixed number of rows. All rows come without an order.
    """
    windows = {"rolling_24h_avg": DAY_ROWS, "rolling_7d_avg": WEEK_ROWS}
    if days30:
        windows["rolling_30d_avg"] = MONTH_ROWS
    df = known_demand(tables).select(*by, HOUR, "demand_mw")
    if limit is None:
        return trailing_means(df, windows, by=by)
    reached = newest_rows(df, limit + max(windows.values()) - 1, by)
    run = Window.partitionBy(*by).orderBy(HOUR)
    means = reached.withColumns(
        {name: F.avg("demand_mw").over(run.rowsBetween(1 - n, 0)) for name, n in windows.items()}
    )
    return top(means, [F.desc(HOUR), *by], limit)


# weather ------------------------------------------------------------------------------------


def temp_demand_corr(
    tables: Tables, *, by: Sequence[str] = (), limit: int | None = 30
) -> DataFrame:
    def full_days(df: DataFrame) -> DataFrame:
        days = _with_weather(df).groupBy(*by, _date().alias("date")).agg(
            F.avg("temp_c").alias("avg_temp_c"),
            F.avg("demand_mw").alias("avg_demand_mw"),
            N.correlation(F.col("temp_c"), F.col("demand_mw")).alias("temp_demand_correlation"),
            F.count(F.lit(1)).alias("_n"),
        )
        return days.where(F.col("_n") >= FULL_DAY).drop("_n")

    return newest_days(tables, "silver_demand_weather", full_days, [F.desc("date"), *by], limit)


def temp_bucket_impact(tables: Tables, *, by: Sequence[str] = ()) -> DataFrame:
    """Demand and wind by temperature bucket; humidity too where the table has it."""
    df = _weathered(tables)
    extra = (
        [F.avg("humidity_pct").alias("avg_humidity")] if "humidity_pct" in df.columns else []
    )
    buckets = df.groupBy(*by, N.temp_bucket(F.col("temp_c")).alias("temp_category")).agg(
        F.count(F.lit(1)).alias("hours"),
        F.avg("demand_mw").alias("avg_demand_mw"),
        F.avg("wind_speed_mps").alias("avg_wind_speed"),
        *extra,
    )
    return buckets.orderBy(*by, F.desc("avg_demand_mw"), "temp_category")


# forecasts and dispatch ---------------------------------------------------------------------


def forecast_daily(
    tables: Tables, *, by: Sequence[str] = (), limit: int | None = 10, all_runs: bool = False
) -> DataFrame:
    def days(df: DataFrame) -> DataFrame:
        rows = df if all_runs else newest_run(df)  # the runs of an hour lie in the hour's day
        return rows.groupBy(*by, _date().alias("forecast_date")).agg(
            F.avg("yhat").alias("avg_forecast_mw"),
            F.avg("yhat_lower").alias("avg_lower_bound"),
            F.avg("yhat_upper").alias("avg_upper_bound"),
            F.avg(F.col("yhat_upper") - F.col("yhat_lower")).alias("avg_confidence_interval"),
            F.count(F.lit(1)).alias("forecast_points"),
        )

    return newest_days(tables, "gold_forecasts", days, [F.desc("forecast_date"), *by], limit)


def forecast_by_hour(
    tables: Tables, *, by: Sequence[str] = (), all_runs: bool = False
) -> DataFrame:
    hours = forecasts(tables, all_runs).groupBy(*by, F.hour(HOUR).alias("forecast_hour")).agg(
        F.avg("yhat").alias("avg_forecast_mw"),
        F.stddev_samp("yhat").alias("forecast_stddev"),
        F.avg(F.col("yhat_upper") - F.col("yhat_lower")).alias("avg_uncertainty"),
    )
    return hours.orderBy(*by, "forecast_hour")


def dispatch_daily(
    tables: Tables,
    *,
    by: Sequence[str] = (),
    faithful: bool = False,
    all_runs: bool = False,
    battery: str | None = BASE_BATTERY,
) -> DataFrame:
    days = dispatch(tables, all_runs, battery).groupBy(*by, _date().alias("date")).agg(
        F.sum("charge_mwh").alias("total_charge_mwh"),
        F.sum("discharge_mwh").alias("total_discharge_mwh"),
        F.avg("soc_mwh").alias("avg_soc_mwh"),
        F.max("soc_mwh").alias("max_soc_mwh"),
        F.min("soc_mwh").alias("min_soc_mwh"),
        F.sum(profit_column(faithful)).alias("daily_profit"),
    )
    return days.orderBy(F.desc("date"), *by)


def dispatch_by_hour(
    tables: Tables,
    *,
    by: Sequence[str] = (),
    all_runs: bool = False,
    battery: str | None = BASE_BATTERY,
) -> DataFrame:
    hours = dispatch(tables, all_runs, battery).groupBy(*by, F.hour(HOUR).alias("hour_of_day")).agg(
        F.avg("charge_mwh").alias("avg_charge_mwh"),
        F.avg("discharge_mwh").alias("avg_discharge_mwh"),
        F.avg("soc_mwh").alias("avg_soc_mwh"),
        F.count(F.lit(1)).alias("observations"),
    )
    return hours.orderBy(*by, "hour_of_day")


def _profits(column: str) -> list[Column]:
    return [
        F.sum(column).alias("total_profit"),
        F.avg(column).alias("avg_hourly_profit"),
        F.max(column).alias("max_hourly_profit"),
        F.min(column).alias("min_hourly_profit"),
    ]


def profit_summary(
    tables: Tables,
    *,
    by: Sequence[str] = (),
    faithful: bool = False,
    all_runs: bool = False,
    battery: str | None = BASE_BATTERY,
) -> DataFrame:
    column = profit_column(faithful)
    return dispatch(tables, all_runs, battery).groupBy(*by).agg(
        *_profits(column), F.stddev_samp(column).alias("profit_stddev")
    )


def dispatch_summary(
    tables: Tables,
    *,
    by: Sequence[str] = (),
    faithful: bool = False,
    all_runs: bool = False,
    battery: str | None = BASE_BATTERY,
) -> DataFrame:
    return dispatch(tables, all_runs, battery).groupBy(*by).agg(
        *_profits(profit_column(faithful)),
        F.avg("soc_mwh").alias("avg_soc_mwh"),
        F.sum("charge_mwh").alias("total_charge_mwh"),
        F.sum("discharge_mwh").alias("total_discharge_mwh"),
    )
