"""Views behind the dashboard and the reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwatt.functions import numbers as N
from hourwatt.functions import times as TM
from hourwatt.operators import analytics as A
from hourwatt.operators.analytics import Tables
from hourwatt.operators.grid import HOUR
from hourwatt.operators.keys import newest_rows
from hourwatt.sources.store import since

FORECAST_COLUMNS = ["yhat", "yhat_lower", "yhat_upper"]
DISPATCH_COLUMNS = [
    "price", "charge_mwh", "discharge_mwh", "soc_mwh", "bid_mwh", "expected_profit",
]


def forecast_horizon(tables: Tables, as_of: datetime, all_runs: bool = False) -> DataFrame:
    """Forecast rows from the current hour on; older day partitions are not read."""
    rows = since(tables["gold_forecasts"], TM.hour_of(as_of))
    return rows if all_runs else A.newest_run(rows)


def dispatch_horizon(
    tables: Tables,
    as_of: datetime,
    all_runs: bool = False,
    battery: str | None = A.BASE_BATTERY,
) -> DataFrame:
    rows = A.one_battery(since(tables["gold_dispatch"], TM.hour_of(as_of)), battery)
    return rows if all_runs else A.newest_run(rows)


def _served(rows: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    rows = rows.orderBy(HOUR, *by)
    return rows.select(*by, TM.iso_text(F.col(HOUR)).alias(HOUR), *columns)


def forecast_horizon_view(
    tables: Tables, as_of: datetime, *, by: Sequence[str] = (), all_runs: bool = False
) -> DataFrame:
    return _served(forecast_horizon(tables, as_of, all_runs), FORECAST_COLUMNS, by)


def dispatch_horizon_view(
    tables: Tables,
    as_of: datetime,
    *,
    by: Sequence[str] = (),
    all_runs: bool = False,
    battery: str | None = A.BASE_BATTERY,
) -> DataFrame:
    return _served(dispatch_horizon(tables, as_of, all_runs, battery), DISPATCH_COLUMNS, by)


def forecast_cards(
    tables: Tables, as_of: datetime, *, by: Sequence[str] = (), all_runs: bool = False
) -> DataFrame:
    """Whole-number average, peak and minimum of the horizon, and its length."""
    return forecast_horizon(tables, as_of, all_runs).groupBy(*by).agg(
        N.shown(F.avg("yhat"), 0).alias("avg_demand"),
        N.shown(F.max("yhat"), 0).alias("peak_demand"),
        N.shown(F.min("yhat"), 0).alias("min_demand"),
        F.count(F.lit(1)).alias("data_points"),
    )


def dispatch_cards(
    tables: Tables,
    as_of: datetime,
    *,
    by: Sequence[str] = (),
    faithful: bool = False,
    all_runs: bool = False,
    battery: str | None = A.BASE_BATTERY,
) -> DataFrame:
    """Totals of the horizon; round-trip efficiency is null when nothing was charged."""
    return dispatch_horizon(tables, as_of, all_runs, battery).groupBy(*by).agg(
        F.sum("charge_mwh").alias("total_charge_mwh"),
        F.sum("discharge_mwh").alias("total_discharge_mwh"),
        F.avg("soc_mwh").alias("avg_soc_mwh"),
        F.sum(A.profit_column(faithful)).alias("total_profit"),
        F.avg("price").alias("avg_price"),
        N.percent(F.sum("discharge_mwh"), F.sum("charge_mwh")).alias("round_trip_pct"),
        F.count(F.lit(1)).alias("data_points"),
    )


def dispatch_chart(
    tables: Tables,
    as_of: datetime,
    *,
    by: Sequence[str] = (),
    battery: str | None = A.BASE_BATTERY,
) -> DataFrame:
    """Display rows: discharge drawn below zero, values with two decimals."""
    rows = dispatch_horizon(tables, as_of, battery=battery).orderBy(HOUR, *by)
    return rows.select(
        *by,
        TM.display_label(TM.iso_text(F.col(HOUR))).alias("label"),
        N.shown(F.col("charge_mwh"), 2).alias("charge_mwh"),
        N.shown(-F.col("discharge_mwh"), 2).alias("discharge_mwh"),
        N.shown(F.col("soc_mwh"), 2).alias("soc_mwh"),
        N.shown(F.col("price"), 2).alias("price"),
    )


def insights(
    tables: Tables, *, faithful: bool = False, battery: str | None = A.BASE_BATTERY
) -> DataFrame:
    """One row: peak and low hour, latest daily correlation, profit, charge level, data volume."""
    profile = A.hourly_profile(tables)
    hour, mean = F.col("hour_of_day"), F.col("avg_demand_mw")
    # The earliest hour wins a tie.
    peak = F.max(F.struct(mean, (-hour).alias("h")))
    low = F.min(F.struct(mean, hour.alias("h")))
    extremes = profile.agg(peak.alias("peak"), low.alias("low"))
    latest = A.temp_demand_corr(tables, limit=1).select("temp_demand_correlation").scalar()
    totals = A.dispatch_summary(tables, faithful=faithful, battery=battery)
    volume = A.table_overview(tables, A.CORE_TABLES)
    return extremes.select(
        (-F.col("peak.h")).alias("peak_hour"),
        F.col("peak.avg_demand_mw").alias("peak_avg_mw"),
        F.col("low.h").alias("min_hour"),
        F.col("low.avg_demand_mw").alias("min_avg_mw"),
        (F.col("peak.avg_demand_mw") - F.col("low.avg_demand_mw")).alias("demand_range_mw"),
        latest.alias("latest_correlation"),
        totals.select("total_profit").scalar().alias("total_profit"),
        totals.select("avg_soc_mwh").scalar().alias("avg_soc_mwh"),
        volume.agg(F.sum("row_count")).scalar().alias("total_rows"),
        volume.agg(F.min("earliest_data")).scalar().alias("data_start"),
        volume.agg(F.max("latest_data")).scalar().alias("data_end"),
    ).withColumn("correlation_label", N.strength_label(F.col("latest_correlation")))


def actual_vs_forecast(
    tables: Tables,
    *,
    actual_rows: int = 168,
    by: Sequence[str] = (),
    run_id: str | None = None,
) -> DataFrame:
    """Last actual hours and one forecast run on one time axis, with the boundary between them."""
    actual = newest_rows(
        tables["silver_demand_weather"].select(*by, HOUR, F.col("demand_mw").alias("value")),
        actual_rows,
        by,
    )
    ends = actual.groupBy(*by).agg(F.max(HOUR).alias("now_boundary"))
    planned = A.one_run(tables["gold_forecasts"], run_id).select(
        *by, HOUR, F.col("yhat").alias("value"), "yhat_lower", "yhat_upper"
    )
    both = actual.withColumn("kind", F.lit("actual")).unionByName(
        planned.withColumn("kind", F.lit("forecast")), allowMissingColumns=True
    )
    if by:
        both = both.join(ends, list(by), "left")
    else:
        both = both.withColumn("now_boundary", ends.scalar())
    columns = [*by, "kind", HOUR, "value", "yhat_lower", "yhat_upper", "now_boundary"]
    return both.select(*columns).orderBy(*by, HOUR, "kind")


def profile_exploration(tables: Tables) -> DataFrame:
    """Mean demand by hour of day and by weekday (Monday = 0), one under the other."""
    df = tables["silver_demand_weather"].where(F.col("demand_mw").isNotNull())
    # Both profiles come from one pass: hour-of-week sums are at most 168 rows.
    cells = df.groupBy(
        F.hour(HOUR).alias("hour"), TM.weekday(F.col(HOUR)).alias("weekday")
    ).agg(F.sum("demand_mw").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    stacked = cells.select(
        F.explode(
            F.array(
                F.struct(F.lit("hour").alias("profile"), F.col("hour").alias("position")),
                F.struct(F.lit("weekday").alias("profile"), F.col("weekday").alias("position")),
            )
        ).alias("cell"),
        "_sum",
        "_n",
    )
    return (
        stacked.groupBy("cell.profile", "cell.position")
        .agg((F.sum("_sum") / F.sum("_n")).alias("avg_demand_mw"))
        .orderBy("profile", "position")
    )


def temp_demand_pairs(tables: Tables) -> DataFrame:
    """Points of the temperature and demand scatter."""
    df = tables["silver_demand_weather"]
    both = F.col("temp_c").isNotNull() & F.col("demand_mw").isNotNull()
    return df.where(both).select(HOUR, "temp_c", "demand_mw")


def forecast_run_summary(
    tables: Tables, *, actual_rows: int = 168, run_id: str | None = None
) -> DataFrame:
    """Hours and values of one forecast run, beside the last actual hours."""
    actual = newest_rows(tables["silver_demand_weather"].select(HOUR, "demand_mw"), actual_rows)
    seen = actual.agg(F.min("demand_mw").alias("lo"), F.max("demand_mw").alias("hi"))
    return A.one_run(tables["gold_forecasts"], run_id).agg(
        F.min(HOUR).alias("forecast_start"),
        F.max(HOUR).alias("forecast_end"),
        F.avg("yhat").alias("avg_forecast_mw"),
        F.max("yhat").alias("max_forecast_mw"),
        F.min("yhat").alias("min_forecast_mw"),
        F.count(F.lit(1)).alias("forecast_points"),
    ).withColumns(
        {
            "min_actual_mw": seen.select("lo").scalar(),
            "max_actual_mw": seen.select("hi").scalar(),
        }
    )


def dispatch_run_summary(tables: Tables, *, run_id: str | None = None) -> DataFrame:
    """One dispatch run. Batteries of one price path are alternatives, so each has its own row."""
    rows = A.one_run(tables["gold_dispatch"], run_id)
    return rows.groupBy("run_id", "series_id", "scenario_id").agg(
        F.sum("charge_mwh").alias("total_charge_mwh"),
        F.sum("discharge_mwh").alias("total_discharge_mwh"),
        F.max("soc_mwh").alias("max_soc_mwh"),
        F.min("soc_mwh").alias("min_soc_mwh"),
        F.sum("hour_profit").alias("run_profit"),
    )


def load_summary(df: DataFrame, value: str, *, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(HOUR).alias("first_hour"),
        F.max(HOUR).alias("last_hour"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def first_and_last(
    df: DataFrame, value: str, *, by: Sequence[str] = (), order: str = HOUR
) -> DataFrame:
    """Value at the first and at the last hour."""
    return df.groupBy(*by).agg(
        F.min_by(value, order).alias("first_value"), F.max_by(value, order).alias("last_value")
    )
