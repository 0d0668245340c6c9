"""Cleaned bronze rows and the gap-free silver table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwatt.functions import numbers as N
from hourwatt.operators.frames import forward_fill
from hourwatt.operators.grid import HOUR, hour_grid, within_days
from hourwatt.operators.keys import latest_per_key

KEY = ["series_id", HOUR]
DEMAND = ["demand_mw", "generation_mw", "forecast_demand_mw"]
WEATHER = ["temp_c", "wind_speed_mps", "wind_dir_deg"]
FILLED = ["demand_mw", "generation_mw", *WEATHER]  # forecast_demand_mw keeps its gaps


def demand_clean(df: DataFrame, as_of: datetime, days: int = 365) -> DataFrame:
    """Trailing window, plus the derived columns where the feed has none of its own."""
    have = df.columns
    generation = N.derived_generation(F.col("demand_mw"))
    if "generation_mw" in have:
        generation = F.coalesce("generation_mw", generation)
    forecast = (
        F.col("forecast_demand_mw") if "forecast_demand_mw" in have else N.null_double()
    )
    return within_days(df, as_of, days).select(
        *KEY,
        "demand_mw",
        generation.alias("generation_mw"),
        forecast.alias("forecast_demand_mw"),
        *(["loaded_at"] if "loaded_at" in have else []),
    )


def weather_hourly(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """One row per key: mean temperature and speed, circular mean direction."""
    return df.groupBy(*keys).agg(
        F.avg("temp_c").alias("temp_c"),
        F.avg("wind_speed_mps").alias("wind_speed_mps"),
        N.mean_direction(F.col("wind_dir_deg")).alias("wind_dir_deg"),
    )


def silver_build(
    demand: DataFrame, weather: DataFrame, newest: str | None = None, weather_by: str = "series"
) -> DataFrame:
    """Hour grid of the demand hours, demand and weather beside it, gaps filled forward.

    ``newest`` names the column that decides between several demand rows of one hour; without it
    demand must already have one row per hour. ``weather_by="hour"`` gives every series the weather
    of its hours, whichever station reported it.
    """
    demand = demand.select(*KEY, *DEMAND, *([newest] if newest else []))
    if newest:
        demand = latest_per_key(demand, KEY, [newest]).drop(newest)
    on = [HOUR] if weather_by == "hour" else KEY
    joined = hour_grid(demand).join(demand, KEY, "left").join(
        weather_hourly(weather, on), on, "left"
    )
    filled = forward_fill(joined.select(*KEY, *DEMAND, *WEATHER), FILLED)
    return filled.select(*KEY, *DEMAND, *WEATHER)
