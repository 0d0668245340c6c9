"""Heatmaps, distributions, decomposition, correlations, accuracy, freshness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourwatt.functions import numbers as N
from hourwatt.functions import times as TM
from hourwatt.operators import analytics as A
from hourwatt.operators.analytics import Tables
from hourwatt.operators.frames import moving_means
from hourwatt.operators.grid import HOUR
from hourwatt.operators.quantiles import exact_quantiles

DAY_COLUMNS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")
PEAK_HOURS = ((6, 9), (18, 21))  # fixed values: morning and evening peak, both ends included
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def hour_weekday_heatmap(tables: Tables) -> DataFrame:
    """Mean demand, one row per hour of day and one column per weekday."""
    hours = A.known_demand(tables).groupBy(F.hour(HOUR).alias("hour_of_day"))
    cells = hours.agg(
        *[
            F.avg(F.when(F.dayofweek(HOUR) == number, F.col("demand_mw"))).alias(name)
            for number, name in enumerate(DAY_COLUMNS, start=1)
        ]
    )
    return cells.orderBy("hour_of_day")


def demand_distribution(
    tables: Tables, part: str = "hour", *, by: Sequence[str] = (), exact: bool = True
) -> DataFrame:
    """Minimum, quartiles and maximum by hour, weekday, date or month."""
    position = {
        "hour": F.hour(HOUR),
        "weekday": F.dayofweek(HOUR),
        "date": F.to_date(HOUR),
        "month": F.month(HOUR),
    }[part]
    df = A.known_demand(tables).select(*by, position.alias("position"), "demand_mw")
    keys = [*by, "position"]
    if exact:
        out = exact_quantiles(df, "demand_mw", QUARTILES, keys)
    else:
        cuts = F.percentile_approx("demand_mw", list(QUARTILES.values()), 10_000)
        out = df.groupBy(*keys).agg(
            F.min("demand_mw").alias("min_value"),
            F.max("demand_mw").alias("max_value"),
            cuts.alias("_cuts"),
        )
        for i, name in enumerate(QUARTILES):
            out = out.withColumn(name, F.col("_cuts")[i])
    return out.select(*keys, "min_value", *QUARTILES, "max_value").orderBy(*keys)


def decompose(tables: Tables, *, by: Sequence[str] = A.SERIES) -> DataFrame:
    """Trend (centred 168-row mean), hour-of-week pattern of what is left, and the residual.

    The frame has 84 rows before and 83 after the row; it is shorter at both ends.
    """
    df = A.known_demand(tables).select(*by, HOUR, "demand_mw")
    half = A.WEEK_ROWS // 2
    trended = moving_means(df, "demand_mw", {"trend": (-half, half - 1)}, by)
    trended = trended.withColumn("_cell", TM.hour_of_week(F.col(HOUR)))
    left = F.col("demand_mw") - F.col("trend")
    seasons = trended.groupBy(*by, "_cell").agg(F.avg(left).alias("seasonal"))
    return (
        trended.join(seasons, [*by, "_cell"])
        .withColumn("residual", left - F.col("seasonal"))
        .select(*by, HOUR, "demand_mw", "trend", "seasonal", "residual")
    )


def corr_matrix(
    tables: Tables,
    columns: Sequence[str] = ("demand_mw", "temp_c", "wind_speed_mps"),
    *,
    by: Sequence[str] = (),
) -> DataFrame:
    """Correlation of each pair of columns, one row per pair; all pairs from one pass."""
    pairs = list(combinations(columns, 2))
    wide = tables["silver_demand_weather"].groupBy(*by).agg(
        *[N.correlation(F.col(x), F.col(y)).alias(f"{x}|{y}") for x, y in pairs]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(x).alias("left_column"),
                F.lit(y).alias("right_column"),
                F.col(f"{x}|{y}").alias("correlation"),
            )
            for x, y in pairs
        ]
    )
    return wide.select(*by, F.inline(rows)).orderBy(*by, "left_column", "right_column")


def forecast_accuracy(
    actual: DataFrame, forecast: DataFrame, *, by: Sequence[str] = ()
) -> DataFrame:
    """Errors over the hours both sides have: MAPE, RMSE, direction hits, band coverage.

    Direction compares the change from the hour before. Windows run over a day; a day's last hour is
    also copied to the day that follows it.
    """
    keys = [*by, HOUR]
    both = actual.where(F.col("demand_mw").isNotNull()).select(*keys, "demand_mw").join(
        forecast.select(*keys, "yhat", "yhat_lower", "yhat_upper"), keys
    )
    day, last = F.to_date(HOUR), F.hour(HOUR) == 23
    both = both.withColumn("_day", F.explode(F.array_compact(F.array(day, F.when(last, day + 1)))))
    run = Window.partitionBy(*by, "_day").orderBy(HOUR)
    just = F.lag(HOUR).over(run) == F.col(HOUR) - F.expr("INTERVAL 1 HOUR")
    both = both.withColumns(
        {f"_{c}_before": F.when(just, F.lag(c).over(run)) for c in ("demand_mw", "yhat")}
    ).where(F.col("_day") == day)
    y, f = F.col("demand_mw"), F.col("yhat")
    moved = F.signum(y - F.col("_demand_mw_before"))
    said = F.signum(f - F.col("_yhat_before"))
    inside = y.between(F.col("yhat_lower"), F.col("yhat_upper"))
    return both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("points"),
        (F.avg(F.try_divide(F.abs(y - f), F.abs(y))) * 100).alias("mape_pct"),
        F.sqrt(F.avg((y - f) * (y - f))).alias("rmse"),
        (F.avg((moved == said).cast("double")) * 100).alias("direction_pct"),
        (F.avg(inside.cast("double")) * 100).alias("coverage_pct"),
    )


def weekend_vs_weekday(tables: Tables, *, by: Sequence[str] = ()) -> DataFrame:
    """Mean demand of weekends and weekdays, in peak and other hours."""
    hour = F.hour(HOUR)
    peak = F.lit(False)
    for first, last in PEAK_HOURS:
        peak = peak | hour.between(first, last)
    day = F.when(F.dayofweek(HOUR).isin(1, 7), "weekend").otherwise("weekday")
    cells = A.known_demand(tables).groupBy(
        *by, day.alias("day_type"), F.when(peak, "peak").otherwise("off_peak").alias("hour_type")
    )
    out = cells.agg(
        F.avg("demand_mw").alias("avg_demand_mw"), F.count(F.lit(1)).alias("hourly_readings")
    )
    return out.orderBy(*by, "day_type", "hour_type")


def freshness(
    tables: Tables, as_of: datetime, names: Sequence[str] = A.ALL_TABLES
) -> DataFrame:
    """Latest hour of each table and how many hours it lies behind ``as_of``."""
    parts = [tables[n].select(F.lit(n).alias("table_name"), HOUR) for n in names]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    latest = rows.groupBy("table_name").agg(F.max(HOUR).alias("latest_data"))
    lag = F.unix_timestamp(TM.at(as_of)) - F.unix_timestamp("latest_data")
    return latest.withColumn("lag_hours", lag / F.lit(3600.0)).orderBy("table_name")
