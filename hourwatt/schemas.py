"""Declared schemas of landed feeds and tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _D, _TS = T.StringType(), T.DoubleType(), T.TimestampType()

# Feed files are JSON documents; ``BROKEN`` holds the text of one that cannot be read.
BROKEN = "_corrupt_record"
DEMAND_ROW = _table(period=_S, value=_S, respondent=_S, type=_S)
DEMAND_FEED = T.StructType(
    [
        T.StructField("response", _table(data=T.ArrayType(DEMAND_ROW)), True),
        T.StructField(BROKEN, _S, True),
    ]
)
WEATHER_FEED = _table(STATION=_S, DATE=_S, TMP=_S, WND=_S, **{BROKEN: _S})

SCHEMAS: dict[str, T.StructType] = {
    "bronze_demand": _table(
        series_id=_S, timestamp_hour=_TS, demand_mw=_D, generation_mw=_D,
        forecast_demand_mw=_D, loaded_at=_TS,
    ),
    "bronze_weather": _table(
        series_id=_S, timestamp_hour=_TS, temp_c=_D, wind_speed_mps=_D, wind_dir_deg=_D,
    ),
    "silver_demand_weather": _table(
        series_id=_S, timestamp_hour=_TS, demand_mw=_D, generation_mw=_D,
        forecast_demand_mw=_D, temp_c=_D, wind_speed_mps=_D, wind_dir_deg=_D,
    ),
    "gold_forecasts": _table(
        series_id=_S, run_id=_S, timestamp_hour=_TS, yhat=_D, yhat_lower=_D, yhat_upper=_D,
        created_at=_TS,
    ),
    "gold_dispatch": _table(
        series_id=_S, scenario_id=_S, run_id=_S, timestamp_hour=_TS, price=_D, charge_mwh=_D,
        discharge_mwh=_D, soc_mwh=_D, bid_mwh=_D, hour_profit=_D, expected_profit=_D,
        status=_S, created_at=_TS,
    ),
}

# One row per key in each table.
KEYS: dict[str, list[str]] = {
    "bronze_demand": ["series_id", "timestamp_hour"],
    "bronze_weather": ["series_id", "timestamp_hour"],
    "silver_demand_weather": ["series_id", "timestamp_hour"],
    "gold_forecasts": ["series_id", "run_id", "timestamp_hour"],
    "gold_dispatch": ["series_id", "scenario_id", "run_id", "timestamp_hour"],
}
