"""The nightly refresh: feeds to bronze, silver, forecasts, dispatch, checks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourwatt.config import EngineConfig
from hourwatt.functions import times as TM
from hourwatt.operators import serving as S
from hourwatt.operators.additive import Model
from hourwatt.operators.dispatch import FLEET, gold_dispatch_rows
from hourwatt.operators.forecast import additive_forecast, gold_forecast_rows
from hourwatt.operators.keys import latest_per_key
from hourwatt.operators.quality import Limits, enforce, quality_gate
from hourwatt.operators.silver import KEY, demand_clean, weather_hourly
from hourwatt.plans.upkeep import refresh_silver
from hourwatt.session import pin_utc
from hourwatt.sources import feeds
from hourwatt.sources.store import TableStore
from hourwatt.streaming.ledger import ingest


def run_name(as_of: datetime) -> str:
    return as_of.strftime("run-%Y%m%dT%H%M%S")


def refresh_bronze(
    spark: SparkSession,
    store: TableStore,
    config: EngineConfig,
    as_of: datetime,
    demand_path: str,
    weather_path: str,
) -> list[DataFrame]:
    """Landed demand and weather files into the bronze tables, one row per series and hour.

    Returns the counts of landed and rejected rows. With ``config.ledger`` only files that have not
    been read before are.
    """
    if config.ledger:
        return [
            ingest(store, "demand", demand_path, lambda rows: load_demand(store, config, as_of, rows)),
            ingest(store, "weather", weather_path, lambda rows: load_weather(store, config, as_of, rows)),
        ]
    demand, weather = feeds.landed_demand(spark, demand_path), feeds.landed_weather(spark, weather_path)
    load_demand(store, config, as_of, demand)
    load_weather(store, config, as_of, weather)
    return [feeds.rejected_demand(demand), feeds.rejected_weather(weather)]


def load_demand(store: TableStore, config: EngineConfig, as_of: datetime, landed: DataFrame) -> None:
    """Landed demand rows into bronze: of several rows for an hour the newest page and place wins."""
    rows = feeds.select_feed(feeds.readable(landed), list(config.stations), config.feed_type)
    newest = latest_per_key(feeds.parse_demand(rows), KEY, feeds.LANDED_ORDER)
    demand = demand_clean(newest, as_of, config.history_days).withColumn("loaded_at", TM.at(as_of))
    store.refresh(demand, "bronze_demand", "loaded_at", noted=True)


def load_weather(store: TableStore, config: EngineConfig, as_of: datetime, landed: DataFrame) -> None:
    first = (as_of - timedelta(days=config.history_days)).date()
    wanted = F.col("STATION").isin(sorted(set(config.stations.values())))
    rows = feeds.readable(landed).where(wanted)
    weather = feeds.clean_weather(rows, first, as_of.date())
    store.refresh(weather_hourly(weather), "bronze_weather", noted=True)


def refresh_bronze_silver(
    spark, store, config, as_of, demand_path, weather_path
) -> list[DataFrame]:
    """Feeds to bronze, then the silver pieces that the changed days reach; the feeds' counts."""
    landed = refresh_bronze(spark, store, config, as_of, demand_path, weather_path)
    refresh_silver(store, config.stations)
    return landed


def forecast_to_gold(
    store: TableStore,
    config: EngineConfig,
    as_of: datetime,
    model: Model = Model(yearly=True),
    series: DataFrame | None = None,
) -> None:
    """Forecasts of all series, or of those that ``series`` names."""
    history = store.scan(
        "silver_demand_weather",
        ["series_id", "timestamp_hour", "demand_mw"],
        start=as_of - timedelta(days=config.history_days),
    ).where(F.col("demand_mw").isNotNull())
    if series is not None:
        history = history.join(series, "series_id", "left_semi")
    if history.isEmpty():
        raise ValueError("no history to forecast from")
    forecast = additive_forecast(
        history, config.horizon_hours, model, as_of=as_of, history_days=config.history_days
    )
    rows = gold_forecast_rows(forecast, run_name(as_of), TM.at(as_of))
    store.refresh(rows, "gold_forecasts", "created_at")


def dispatch_to_gold(
    store: TableStore,
    config: EngineConfig,
    as_of: datetime,
    fleet=FLEET,
    series: DataFrame | None = None,
) -> None:
    """Trade each battery against the newest forecast, whose values stand in for prices."""
    prices = S.forecast_horizon(store, as_of).withColumnRenamed("yhat", "price")
    if series is not None:
        prices = prices.join(series, "series_id", "left_semi")
    if prices.isEmpty():
        raise ValueError("no forecast from the current hour on")
    rows = gold_dispatch_rows(prices, run_name(as_of), TM.at(as_of), fleet)
    store.refresh(rows, "gold_dispatch", "created_at")


def nightly(
    spark: SparkSession,
    config: EngineConfig,
    as_of: datetime,
    demand_path: str,
    weather_path: str,
    limits: Limits = Limits(),
) -> DataFrame:
    """All steps in order; the first failure stops the run. Returns the checks that passed.

    Steps hand over through tables only, and each one is idempotent for its ``as_of``: a run that
    lost its driver is simply started again.
    """
    pin_utc(spark)
    store = TableStore(spark, config.root, facts=True)
    landed = refresh_bronze_silver(spark, store, config, as_of, demand_path, weather_path)
    forecast_to_gold(store, config, as_of)
    dispatch_to_gold(store, config, as_of)
    checks = quality_gate(store, as_of, limits, landed=landed)
    enforce(checks)
    return checks
