"""Named queries over the test tables.

Each entry states its result columns as ``name:kind`` with the kinds ts, d(ate), i(nt), l(ong),
s(tring), b(oolean) and x (double, rounded to six digits, or to as many as the kind says).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourwatt.config import EngineConfig
from hourwatt.functions import numbers as N
from hourwatt.functions import times as TM
from hourwatt.operators import analytics as A
from hourwatt.operators import dispatch as D
from hourwatt.operators import explore as X
from hourwatt.operators import forecast as FC
from hourwatt.operators import grid as G
from hourwatt.operators import keys as K
from hourwatt.operators import quality as QL
from hourwatt.operators import serving as S
from hourwatt.operators import silver as SV
from hourwatt.operators.additive import Model
from hourwatt.operators.frames import forward_fill
from hourwatt.operators.grid import HOUR
from hourwatt.plans import landing, nightly, upkeep
from hourwatt.session import new_folder
from hourwatt.sources import feeds
from hourwatt.sources.sample import AS_OF, BACKTEST_CUT, CREATED, EVENTS, SampleTables
from hourwatt.sources.store import TableStore, conform, since
from hourwatt.streaming import ledger
from hourwatt.streaming import refresh as ST

KINDS = {
    "d": "date", "i": "int", "l": "bigint", "x": "double", "s": "string",
    "b": "boolean",
}
SERIES = 5  # series in the multi-series variants
MID_MONTH = datetime(2024, 1, 15, 12, 34)  # clock of the dispatch views
LOSSLESS = D.Battery("lossless", 100.0, 50.0, 1.0, 1.0)
FAST = D.Battery("fast", 100.0, 200.0)  # fills or empties within an hour
STEPS = D.Store(eta_c=1.0, low=10.0, high=100.0, start=50.0)  # levels in steps of 10 suffice


def nudge(digits: int) -> float:
    """Added before rounding, so that no engine has to decide where an exact half goes."""
    return round(0.0371 * 10**-digits, digits + 4)


@dataclass(frozen=True)
class Entry:
    build: Callable[[SampleTables], DataFrame]
    contract: str
    series: int

    def columns(self) -> list[tuple[str, str, int]]:
        parts = (part.rsplit(":", 1) for part in self.contract.split())
        return [
            (name, "x", int(kind[1:] or 6)) if kind.startswith("x") else (name, kind, 0)
            for name, kind in parts
        ]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(SampleTables(spark, sf_dir, self.series))
        return df.select(*[self._cell(*column).alias(column[0]) for column in self.columns()])

    def _cell(self, name: str, kind: str, digits: int) -> Column:
        value = TM.naive(F.col(name)) if kind == "ts" else F.col(name).cast(KINDS[kind])
        if kind != "x":
            return value
        value = F.round(value + nudge(digits), digits)
        return F.when(value == 0, 0.0).otherwise(value)  # no negative zero


REGISTRY: dict[str, Entry] = {}


def query(contract: str, series: int = 1):
    def add(build):
        REGISTRY[build.__name__] = Entry(build, contract, series)
        return build

    return add


class Replaced(dict):
    """Tables with some of them replaced; the others stay lazy."""

    def __init__(self, tables, **others):
        super().__init__(others)
        self.tables = tables

    def __missing__(self, name):
        return self.tables[name]


def orders_as_demand(t: SampleTables) -> Replaced:
    return Replaced(t, bronze_demand=t.order_months())


# overview and quality -----------------------------------------------------------------------

_OVERVIEW = "table_name:s row_count:l earliest_data:ts latest_data:ts unique_days:l"


@query(_OVERVIEW)
def table_overview(t):
    return A.table_overview(t)


@query(_OVERVIEW)
def table_overview_core(t):
    return A.table_overview(t, A.CORE_TABLES)


@query("table_name:s total_rows:l non_null_demand:l missing_demand:l missing_pct:x")
def missing_data(t):
    return A.missing_data(t)


@query(f"{HOUR}:ts demand_mw:x z_score:x")
def demand_outliers(t):
    return A.demand_outliers(t)


@query(f"{HOUR}:ts demand_mw:x z_score:x")
def demand_outliers_top10(t):
    return A.demand_outliers(t, limit=10)


@query(f"series_id:s {HOUR}:ts demand_mw:x z_score:x", series=SERIES)
def demand_outliers_by_series(t):
    return A.demand_outliers(t, by=["series_id"], limit=None)


@query("table_name:s latest_data:ts lag_hours:x")
def freshness(t):
    return X.freshness(t, AS_OF)


@query("check_name:s table_name:s value:x limit_value:x passed:b")
def quality_gate(t):
    """The checks over stored tables, as the nightly run applies them: from facts of days."""
    store = TableStore(t.spark, new_folder(t.spark, "store"), facts=True)
    for name in ("bronze_demand", "bronze_weather", "gold_dispatch"):
        store.append(t[name], name)
    silver = SV.silver_build(store["bronze_demand"], store["bronze_weather"])
    store.append(silver, "silver_demand_weather")
    forecast = FC.seasonal_profile_forecast(store["silver_demand_weather"], profile="hour")
    rows = FC.gold_forecast_rows(forecast, "run-1", TM.at(CREATED))
    store.append(rows, "gold_forecasts")
    return QL.quality_gate(store, AS_OF)


@query("date:d avg_temp_c:x avg_demand_mw:x temp_demand_correlation:x")
def temp_demand_corr_stored(t):
    """From a stored table, of which only the newest days are read."""
    store = _store(t)
    store.append(t["silver_demand_weather"], "silver_demand_weather")
    return A.temp_demand_corr(store, limit=5)


@query(f"series_id:s {HOUR}:ts copies:l")
def duplicate_keys(t):
    return QL.duplicate_keys(t.demand_raw(), SV.KEY)


# demand -------------------------------------------------------------------------------------

_DEMAND = "avg_demand_mw:x min_demand_mw:x max_demand_mw:x"


@query(f"date:d {_DEMAND} demand_stddev:x hourly_readings:l")
def daily_demand(t):
    return A.daily_demand(t)


@query(f"hour_of_day:i {_DEMAND} sample_count:l")
def hourly_profile(t):
    return A.hourly_profile(t)


@query(f"series_id:s hour_of_day:i {_DEMAND} sample_count:l", series=SERIES)
def hourly_profile_by_series(t):
    return A.hourly_profile(t, by=["series_id"])


@query(f"day_of_week:i day_name:s {_DEMAND}")
def weekday_profile(t):
    return A.weekday_profile(t)


@query(f"month:i year:i {_DEMAND} hourly_readings:l")
def monthly_demand(t):
    return A.monthly_demand(orders_as_demand(t))


@query("month:i seasonal_avg:x seasonal_min:x seasonal_max:x sample_size:l")
def monthly_seasonality(t):
    return A.monthly_seasonality(orders_as_demand(t))


@query("year:i month:i avg_demand_mw:x prev_month_avg:x month_over_month_change:x")
def mom_growth(t):
    return A.mom_growth(orders_as_demand(t))


@query("date:d peak_demand_mw:x peak_hour:i")
def peak_days(t):
    return A.peak_days(t)


@query(f"{HOUR}:ts demand_mw:x rolling_24h_avg:x rolling_7d_avg:x")
def rolling_averages(t):
    return A.rolling_averages(t)


@query(f"series_id:s {HOUR}:ts demand_mw:x rolling_24h_avg:x rolling_7d_avg:x", series=SERIES)
def rolling_averages_all_rows(t):
    return A.rolling_averages(t, by=["series_id"], limit=None)


@query(f"{HOUR}:ts demand_mw:x rolling_24h_avg:x rolling_7d_avg:x rolling_30d_avg:x")
def rolling_30d(t):
    return A.rolling_averages(t, days30=True)


@query("date:d min_demand:x max_demand:x daily_range:x daily_volatility:x hourly_readings:l")
def volatility_days(t):
    return A.volatility_days(t)


@query("date:d avg_demand:x avg_generation:x efficiency_ratio:x hourly_readings:l")
def efficiency_daily(t):
    return A.efficiency_daily(t)


# weather ------------------------------------------------------------------------------------


@query("date:d avg_temp_c:x avg_demand_mw:x temp_demand_correlation:x")
def temp_demand_corr(t):
    return A.temp_demand_corr(t)


@query("date:d avg_temp_c:x avg_demand_mw:x temp_demand_correlation:x")
def temp_demand_corr_newest10(t):
    return A.temp_demand_corr(t, limit=10)


@query("temp_category:s hours:l avg_demand_mw:x avg_wind_speed:x")
def temp_bucket_impact(t):
    return A.temp_bucket_impact(t)


_OBSERVED = f"{HOUR}:ts temp_c:x wind_speed_mps:x wind_dir_deg:x"


@query(_OBSERVED)
def weather_clean(t):
    return feeds.clean_weather(t.weather_raw(), date(2024, 1, 3), date(2024, 1, 28))


@query(_OBSERVED)
def weather_clean_sentinels(t):
    return feeds.clean_weather(t.weather_raw(), keep_sentinels=True)


@query(_OBSERVED)
def weather_hourly(t):
    return SV.weather_hourly(feeds.clean_weather(t.weather_raw()))


@query(_OBSERVED)
def weather_feed_json(t):
    config = EngineConfig("")
    path = landing.land_weather(t, config.station)
    return feeds.read_weather_json(
        t.spark, path, config.station, date(2024, 1, 10), date(2024, 1, 20)
    )


# bronze and silver --------------------------------------------------------------------------

_BRONZE = f"{HOUR}:ts demand_mw:x generation_mw:x forecast_demand_mw:x"
_SILVER = f"{_BRONZE} temp_c:x wind_speed_mps:x wind_dir_deg:x"


@query(f"{HOUR}:ts demand_mw:x")
def demand_feed_json(t):
    path = landing.land_demand(t, "ERCO")
    return feeds.read_demand_json(t.spark, path, "ERCO", "D")


@query("period:s value:s type:s")
def demand_feed_select(t):
    """What one request serves of a feed that holds more: every event, and again a year later."""
    rows = t.events.select("*", F.explode(F.array(F.lit(0), F.lit(365))).alias("days")).select(
        F.date_format(F.col("ts") + F.make_dt_interval("days"), "yyyy-MM-dd'T'HH:mm:ss").alias("period"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
        F.lit("ERCO").alias("respondent"),
        F.when(F.col("event_id") % 8 == 0, "NG").otherwise("D").alias("type"),
    )
    return feeds.select_feed(rows, "ERCO", "D", feeds.FEED_LIMIT)


@query(f"{HOUR}:ts demand_mw:x")
def first_non_empty_feed(t):
    nothing = t.of_type("no such type")
    return feeds.first_non_empty(
        lambda: t.spark.read.parquet(f"{t.sf_dir}/no_such_feed"),
        lambda: nothing.select(HOUR, F.col("value").alias("demand_mw")),
        lambda: t["bronze_demand"].select(HOUR, "demand_mw"),
    )


@query(_BRONZE)
def demand_clean(t):
    rows = t.demand_raw().select(*SV.KEY, "demand_mw")
    return SV.demand_clean(rows, datetime(2025, 1, 14, 12, 0))


@query(_BRONZE)
def latest_per_key(t):
    return K.latest_per_key(t.demand_raw(), SV.KEY, ["load_no"])


@query(_SILVER)
def silver_build(t):
    return SV.silver_build(t["bronze_demand"], t["bronze_weather"])


@query(f"series_id:s {_SILVER}", series=SERIES)
def silver_build_by_series(t):
    return SV.silver_build(t["bronze_demand"], t["bronze_weather"])


@query(_SILVER)
def silver_build_from_duplicates(t):
    weather = feeds.clean_weather(t.weather_raw())
    return SV.silver_build(t.demand_raw(), weather, newest="load_no", weather_by="hour")


@query(f"series_id:s {HOUR}:ts", series=SERIES)
def hour_grid(t):
    return G.hour_grid(t["bronze_demand"])


@query(f"series_id:s {HOUR}:ts", series=SERIES)
def future_hours(t):
    return G.future_hours(t["bronze_demand"], 48)


@query(f"series_id:s {HOUR}:ts demand_mw:x", series=SERIES)
def forward_fill_gaps(t):
    gaps = G.hour_grid(t["bronze_demand"]).join(t["bronze_demand"], SV.KEY, "left")
    return forward_fill(gaps.select(*SV.KEY, "demand_mw"), ["demand_mw"])


# tables and sinks ---------------------------------------------------------------------------


def _store(t: SampleTables) -> TableStore:
    return TableStore(t.spark, new_folder(t.spark, "tables"))


@query(f"{HOUR}:ts yhat:x")
def table_scan(t):
    store = _store(t)
    store.append(t["gold_forecasts"], "gold_forecasts")
    return store.scan("gold_forecasts", [HOUR, "yhat"], AS_OF)


@query("series_id:s copies:l demand_total:x")
def append_rows(t):
    store = _store(t)
    store.append(t["bronze_demand"], "bronze_demand")
    store.append(t["bronze_demand"], "bronze_demand")
    return store["bronze_demand"].groupBy("series_id").agg(
        F.count(F.lit(1)).alias("copies"), F.sum("demand_mw").alias("demand_total")
    )


@query(_SILVER)
def replace_table(t):
    store = _store(t)
    store.replace(t["silver_demand_weather"], "silver_demand_weather")
    store.replace(store["silver_demand_weather"], "silver_demand_weather")
    return store["silver_demand_weather"]


@query(f"event_date:d run_id:s {HOUR}:ts yhat:x created_at:ts")
def day_partitioned_gold(t):
    """Two nights, the second one twice: one row per run and hour."""
    store, inbox = _store(t), _store(t)
    inbox.append(t.forecasts_two_runs(), "gold_forecasts")
    rows = inbox["gold_forecasts"]
    for run in ("run-1", "run-2", "run-2"):
        store.refresh(rows.where(F.col("run_id") == run), "gold_forecasts", "created_at")
    return store["gold_forecasts"]


@query("series_id:s demand_mw:x generation_mw:x loaded_at:ts")
def conform_schema(t):
    return conform(t["bronze_demand"].select("demand_mw", HOUR, "series_id"), "bronze_demand")


# expressions --------------------------------------------------------------------------------


@query(
    "event_id:l day:d hour:i month:i year:i day_of_week:i weekday:i day_name:s hour_of_week:i"
    f" {HOUR}:ts"
)
def calendar_parts(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.to_date(ts).alias("day"),
        F.hour(ts).alias("hour"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        TM.day_of_week(ts).alias("day_of_week"),
        TM.weekday(ts).alias("weekday"),
        TM.day_name(ts).alias("day_name"),
        TM.hour_of_week(ts).alias("hour_of_week"),
        TM.floor_hour(ts).alias(HOUR),
    )


@query(f"event_id:l {HOUR}:ts demand_mw:x")
def feed_value_parse(t):
    """Both ways to write an hour, and values that are no numbers."""
    odd = F.col("event_id") % 2 == 1
    period = F.when(odd, F.date_format("ts", "yyyy-MM-dd'T'HH")).otherwise(
        F.concat(F.date_format("ts", "yyyyMMdd'T'HH"), F.lit("Z"))
    )
    period = F.when(F.col("event_id") % 31 == 0, "yesterday").otherwise(period)
    number = F.col("event_id")
    value = (
        F.when(number % 7 == 0, "abc")
        .when(number % 11 == 0, "")
        .when(number % 13 == 0, "NaN")
        .when(number % 17 == 0, "1d")
        .otherwise(F.col("value").cast("string"))
    )
    return t.events.select(
        "event_id", TM.feed_hour(period).alias(HOUR), N.to_number(value).alias("demand_mw")
    )


@query("event_id:l label:s")
def display_labels(t):
    text = (
        F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("event_id") % 4 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("soon")
    )
    return t.events.select("event_id", TM.display_label(text).alias("label"))


@query(
    f"{HOUR}:ts sin_daily:x cos_daily:x sin_weekly:x cos_weekly:x sin_yearly:x cos_yearly:x"
)
def seasonal_terms(t):
    return t["bronze_demand"].select(HOUR, *N.seasonal_terms(F.col(HOUR)))


# forecasts ----------------------------------------------------------------------------------

_FORECAST = f"{HOUR}:ts yhat:x yhat_lower:x yhat_upper:x"


@query("forecast_date:d avg_forecast_mw:x avg_lower_bound:x avg_upper_bound:x"
       " avg_confidence_interval:x forecast_points:l")
def forecast_daily(t):
    return A.forecast_daily(t)


@query("forecast_date:d avg_forecast_mw:x forecast_points:l")
def forecast_daily_newest_run(t):
    return A.forecast_daily(Replaced(t, gold_forecasts=t.forecasts_two_runs()))


@query("forecast_date:d avg_forecast_mw:x forecast_points:l")
def forecast_daily_all_runs(t):
    return A.forecast_daily(Replaced(t, gold_forecasts=t.forecasts_two_runs()), all_runs=True)


@query("forecast_hour:i avg_forecast_mw:x forecast_stddev:x avg_uncertainty:x")
def forecast_by_hour(t):
    return A.forecast_by_hour(t)


@query(_FORECAST)
def seasonal_profile_forecast(t):
    return FC.seasonal_profile_forecast(t["silver_demand_weather"], profile="hour")


@query(f"series_id:s {_FORECAST}", series=SERIES)
def seasonal_profile_forecast_weekly(t):
    return FC.seasonal_profile_forecast(t["silver_demand_weather"], profile="hour_of_week")


@query(f"series_id:s {_FORECAST}", series=SERIES)
def additive_forecast(t):
    return FC.additive_forecast(t["silver_demand_weather"])


@query(f"series_id:s {_FORECAST}", series=SERIES)
def additive_forecast_trend_only(t):
    """The straight-line case of the model, which has a closed form."""
    line = Model(daily=False, weekly=False, yearly=False, hinges=0, shrink=False)
    return FC.additive_forecast(t["silver_demand_weather"], model=line)


@query("series_id:s i:i j:i total:x4", series=SERIES)
def additive_normal_equations(t):
    """Sums of feature products of a trend with a daily season; column 10 is that of the values."""
    model = Model(weekly=False, yearly=False, hinges=0)
    found = FC.normal_equations(t["silver_demand_weather"], model)
    cells = found.select("series_id", F.posexplode("sums").alias("p", "total")).where("p < 110")
    place = F.col("p")
    return cells.withColumns(
        {
            "i": F.when(place < 100, F.floor(place / 10)).otherwise(place - 100),
            "j": F.when(place < 100, place % 10).otherwise(10),
        }
    )


@query("series_id:s first_hour:ts last_hour:ts points:l ordered:b", series=SERIES)
def additive_forecast_shape(t):
    df = FC.additive_forecast(t["silver_demand_weather"], as_of=AS_OF)
    inside = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return df.groupBy("series_id").agg(
        F.min(HOUR).alias("first_hour"),
        F.max(HOUR).alias("last_hour"),
        F.count_distinct(HOUR).alias("points"),
        F.bool_and(inside).alias("ordered"),
    )


@query("points:l mape_pct:x rmse:x direction_pct:x coverage_pct:x")
def forecast_accuracy(t):
    """Against hours that were measured; hours filled forward are no actual values."""
    past = t["silver_demand_weather"].where(F.col(HOUR) < TM.at(BACKTEST_CUT))
    forecast = FC.seasonal_profile_forecast(past, profile="hour")
    return X.forecast_accuracy(t["bronze_demand"], forecast)


@query(f"run_id:s created_at:ts {_FORECAST}")
def forecast_to_gold(t):
    store = _store(t)
    forecast = FC.seasonal_profile_forecast(t["silver_demand_weather"], profile="hour")
    rows = FC.gold_forecast_rows(forecast, "run-1", TM.at(CREATED))
    store.refresh(rows, "gold_forecasts", "created_at")
    return store["gold_forecasts"]


# dispatch -----------------------------------------------------------------------------------

_DISPATCH_DAY = (
    "date:d total_charge_mwh:x total_discharge_mwh:x avg_soc_mwh:x max_soc_mwh:x min_soc_mwh:x"
    " daily_profit:x1"
)


@query(_DISPATCH_DAY)
def dispatch_daily(t):
    return A.dispatch_daily(t)


@query(_DISPATCH_DAY)
def dispatch_daily_run_totals(t):
    return A.dispatch_daily(t, faithful=True)


@query("hour_of_day:i avg_charge_mwh:x avg_discharge_mwh:x avg_soc_mwh:x observations:l")
def dispatch_by_hour(t):
    return A.dispatch_by_hour(t)


_PROFITS = "total_profit:x1 avg_hourly_profit:x1 max_hourly_profit:x1 min_hourly_profit:x1"


@query(f"{_PROFITS} profit_stddev:x3")
def profit_summary(t):
    return A.profit_summary(t)


@query(_PROFITS.replace("total_profit:x1", "total_profit:x-2"))
def profit_summary_run_totals(t):
    return A.profit_summary(t, faithful=True)


@query(f"{_PROFITS} avg_soc_mwh:x total_charge_mwh:x total_discharge_mwh:x")
def dispatch_summary(t):
    return A.dispatch_summary(t)


def _fleet(t) -> Replaced:
    """The dispatch table as a nightly run leaves it: three batteries, alternatives to each other."""
    return Replaced(t, gold_dispatch=t.dispatch_fleet())


@query(_DISPATCH_DAY)
def dispatch_daily_fleet(t):
    return A.dispatch_daily(_fleet(t))


@query("hour_of_day:i avg_charge_mwh:x avg_discharge_mwh:x avg_soc_mwh:x observations:l")
def dispatch_by_hour_fleet(t):
    return A.dispatch_by_hour(_fleet(t))


@query(f"{_PROFITS} profit_stddev:x3")
def profit_summary_fleet(t):
    return A.profit_summary(_fleet(t))


@query(f"{_PROFITS} avg_soc_mwh:x total_charge_mwh:x total_discharge_mwh:x")
def dispatch_summary_fleet(t):
    return A.dispatch_summary(_fleet(t))


@query(f"scenario_id:s {_PROFITS} avg_soc_mwh:x total_charge_mwh:x total_discharge_mwh:x")
def dispatch_summary_by_battery(t):
    return A.dispatch_summary(_fleet(t), by=["scenario_id"], battery=None)


_RUN = (
    "run_id:s series_id:s scenario_id:s total_charge_mwh:x total_discharge_mwh:x max_soc_mwh:x"
    " min_soc_mwh:x run_profit:x2"
)


@query(_RUN)
def dispatch_run_summary(t):
    return S.dispatch_run_summary(t)


@query(_RUN)
def dispatch_run_summary_runs(t):
    return S.dispatch_run_summary(Replaced(t, gold_dispatch=t.dispatch_runs()))


@query(f"{HOUR}:ts price:x bid_mwh:x")
def optimal_bid(t):
    rows = t["gold_dispatch"].withColumn("price", F.col("price") - 100)
    return rows.select(HOUR, "price", D.optimal_bid(F.col("price"), F.lit(0.01)).alias("bid_mwh"))


@query(f"{HOUR}:ts hour_profit:x3 expected_profit:x2")
def dispatch_profit(t):
    return D.dispatch_profit(t["gold_dispatch"].drop("hour_profit", "expected_profit"))


def daily_prices(t: SampleTables) -> DataFrame:
    """Hourly prices per series and delivery day, some of them negative."""
    rows = t["bronze_demand"].where(F.col("demand_mw").isNotNull())
    return rows.select(
        "series_id", HOUR, F.to_date(HOUR).alias("day"), (F.col("demand_mw") - 40).alias("price")
    )


@query(
    f"series_id:s scenario_id:s {HOUR}:ts price:x charge_mwh:x discharge_mwh:x soc_mwh:x"
    " bid_mwh:x status:s",
    series=SERIES,
)
def battery_dispatch(t):
    return D.battery_dispatch(daily_prices(t), per=["day"])


@query("series_id:s day:d trading_value:x", series=SERIES)
def battery_dispatch_lossless_value(t):
    """Largest trading value per day of a battery without losses."""
    solved = D.battery_dispatch(daily_prices(t), [LOSSLESS], per=["day"])
    earned = F.col("price") * (F.col("discharge_mwh") - F.col("charge_mwh"))
    return solved.groupBy("series_id", "day").agg(F.sum(earned).alias("trading_value"))


@query("series_id:s day:d trading_value:x4", series=SERIES)
def battery_dispatch_lossy_value(t):
    """Largest trading value per day with the usual losses, where power never binds."""
    prices = daily_prices(t).withColumn("price", F.col("price") + 40)
    solved = D.battery_dispatch(prices, [FAST], per=["day"])
    earned = F.col("price") * (F.col("discharge_mwh") - F.col("charge_mwh"))
    return solved.groupBy("series_id", "day").agg(F.sum(earned).alias("trading_value"))


@query("series_id:s hours:l trading_value:x4 run_total:x3", series=SERIES)
def battery_dispatch_long(t):
    """One horizon per series, as long as its history: no hour is left out."""
    prices = daily_prices(t).withColumn("price", F.col("price") + 40)
    solved = D.gold_dispatch_rows(prices, "run-1", TM.at(CREATED), [FAST])
    earned = F.col("price") * (F.col("discharge_mwh") - F.col("charge_mwh"))
    return solved.groupBy("series_id").agg(
        F.count("soc_mwh").alias("hours"),
        F.sum(earned).alias("trading_value"),
        F.max("expected_profit").alias("run_total"),
    )


@query("series_id:s hours:l trading_value:x4 run_total:x3", series=SERIES)
def battery_dispatch_blocks(t):
    """The same horizons, solved in blocks of three days with their neighbours."""
    prices = daily_prices(t).withColumn("price", F.col("price") + 40)
    solved = D.long_battery_dispatch(prices, [FAST], block=72)
    earned = F.col("price") * (F.col("discharge_mwh") - F.col("charge_mwh"))
    return solved.groupBy("series_id").agg(
        F.count("soc_mwh").alias("hours"),
        F.sum(earned).alias("trading_value"),
        F.sum(D.hour_profit()).alias("run_total"),
    )


@query("scenario_id:s hours:l horizons:l violations:l bid_total:x3", series=SERIES)
def battery_dispatch_audit(t):
    """Each scenario has a plan for every hour, and no plan breaks a rule."""
    solved = D.battery_dispatch(daily_prices(t), per=["day"])
    broken = D.dispatch_check(solved, per=["series_id", "day", "scenario_id"])
    broken = broken.groupBy("scenario_id").agg(F.count(F.lit(1)).alias("violations"))
    counted = solved.groupBy("scenario_id").agg(
        F.count("soc_mwh").alias("hours"),
        F.count_distinct("series_id", "day").alias("horizons"),
        F.sum("bid_mwh").alias("bid_total"),
    )
    return counted.join(broken, "scenario_id", "left").withColumn(
        "violations", F.coalesce("violations", F.lit(0))
    )


@query(f"{HOUR}:ts residual:x balance:b level:b power:b")
def dispatch_check(t):
    rows = t["gold_dispatch"]
    battery = D.FLEET[0]
    rows = rows.withColumns({c: F.lit(getattr(battery, c)) for c in D.BATTERY_COLUMNS})
    found = D.dispatch_check(rows)
    return found.select(
        HOUR,
        "residual",
        *[F.array_contains("violations", c).alias(c) for c in ("balance", "level", "power")],
    )


@query(f"{HOUR}:ts demand_mw:x wind_mw:x solar_mw:x gas_mw:x cost:x unserved_mw:x")
def merit_order(t):
    demand = t["silver_demand_weather"].select(HOUR, (F.col("demand_mw") * 4).alias("demand_mw"))
    return D.merit_order(demand)


def stepped_demand(t: SampleTables) -> DataFrame:
    """Demand in steps of 10 MW, around the capacity of the generators."""
    steps = F.floor(F.col("demand_mw") * 6 / 10) * 10.0
    rows = t["silver_demand_weather"].where(F.col("demand_mw").isNotNull())
    return rows.select("series_id", HOUR, F.to_date(HOUR).alias("day"), steps.alias("demand_mw"))


@query("series_id:s day:d hours:l status:s total_cost:x4", series=SERIES)
def generation_dispatch_least_cost(t):
    """Least cost per day with a store: demand and levels in steps, so that all plans can be tried."""
    solved = D.generation_dispatch(stepped_demand(t), store=STEPS, per=["series_id", "day"])
    return solved.groupBy("series_id", "day", "status").agg(
        F.count(F.lit(1)).alias("hours"),
        F.sum(F.when(F.col("status") == "optimal", F.col("cost"))).alias("total_cost"),
    )


@query("series_id:s day:d hours:l status:s total_cost:x4", series=SERIES)
def dispatch_feasibility(t):
    costs = D.dispatch_feasibility(stepped_demand(t), store=STEPS, per=["series_id", "day"])
    return costs.groupBy("series_id", "day", "status").agg(
        F.count(F.lit(1)).alias("hours"),
        F.sum(F.when(F.col("status") == "optimal", F.col("cost"))).alias("total_cost"),
    )


@query("series_id:s hours:l differing:l", series=SERIES)
def dispatch_feasibility_agrees(t):
    """Between 1,500 and 1,900 MW, with the usual store: the same status from both operators."""
    rows = stepped_demand(t).withColumn("demand_mw", F.col("demand_mw") % 400 + 1500)
    per = ["series_id", "day"]
    a = D.dispatch_feasibility(rows, per=per).select(*per, HOUR, F.col("status").alias("a"))
    b = D.generation_dispatch(rows, per=per).select(*per, HOUR, F.col("status").alias("b"))
    both = a.join(b, [*per, HOUR], "full")
    return both.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("hours"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differing")
    )


@query(
    f"series_id:s day:d {HOUR}:ts demand_mw:x charge_mwh:x discharge_mwh:x soc_mwh:x status:s"
    " net_load_mw:x wind_mw:x solar_mw:x gas_mw:x cost:x",
    series=SERIES,
)
def generation_dispatch(t):
    rows = t["silver_demand_weather"].withColumn("demand_mw", F.col("demand_mw") * 6)
    rows = rows.withColumn("day", F.to_date(HOUR))
    return D.generation_dispatch(rows, store=D.Store(low=10.0, high=100.0, start=50.0),
                                 per=["series_id", "day"])


@query("series_id:s hours:l violations:l dearer_days:l", series=SERIES)
def generation_dispatch_audit(t):
    """No plan breaks a rule, and none costs more than serving the same day without the store."""
    store, day = D.Store(low=10.0, high=100.0, start=50.0), ["series_id", "day"]
    plans = generation_dispatch(t).withColumnRenamed("cost", "plan_cost")
    rows = D.merit_order(plans.drop("wind_mw", "solar_mw", "gas_mw"))
    before = F.lag("soc_mwh", 1, store.start).over(Window.partitionBy(*day).orderBy(HOUR))
    moved = F.col("charge_mwh") * store.eta_c - F.col("discharge_mwh")
    capacity = sum(g.capacity_mw for g in D.GENERATORS)
    broken = (
        (F.abs(F.col("soc_mwh") - before - moved) > 1e-6)
        | ~F.col("soc_mwh").between(store.low - 1e-6, store.high + 1e-6)
        | (F.greatest("charge_mwh", "discharge_mwh") > store.power_mw + 1e-6)
        | (F.col("net_load_mw") > capacity + 1e-6)
    )
    rows = rows.withColumn("broken", F.coalesce(broken, F.lit(False)))
    dearer = F.coalesce(F.sum("plan_cost") > F.sum("cost") + 1e-6, F.lit(True))
    days = rows.groupBy(*day).agg(
        F.count(F.lit(1)).alias("hours"),
        F.count_if("broken").alias("violations"),
        ((F.max(F.coalesce("unserved_mw", F.lit(1.0))) == 0) & dearer).alias("dearer"),
    )
    return days.groupBy("series_id").agg(
        F.sum("hours").alias("hours"),
        F.sum("violations").alias("violations"),
        F.count_if("dearer").alias("dearer_days"),
    )


@query("series_id:s day:d hours:l status:s total_cost:x4", series=SERIES)
def generation_dispatch_without_store(t):
    """With a store that cannot move energy the least cost is the merit order's."""
    rows = t["silver_demand_weather"].withColumn("demand_mw", F.col("demand_mw") * 6)
    rows = rows.withColumn("day", F.to_date(HOUR))
    still = D.Store(power_mw=0.0)
    solved = D.generation_dispatch(rows, store=still, per=["series_id", "day"])
    return solved.groupBy("series_id", "day", "status").agg(
        F.count(F.lit(1)).alias("hours"), F.sum("cost").alias("total_cost")
    )


@query("source:s total_mwh:x4 total_cost:x4")
def generation_mix_summary(t):
    demand = t["silver_demand_weather"].select(HOUR, (F.col("demand_mw") * 4).alias("demand_mw"))
    return D.generation_mix_summary(D.merit_order(demand))


@query("peak_soc:x min_soc:x")
def store_summary(t):
    return D.store_summary(t["gold_dispatch"])


@query("scenario_id:s run_id:s hours:l first_hour:ts last_hour:ts bid_total:x3")
def dispatch_to_gold(t):
    store = _store(t)
    store.append(t["gold_forecasts"], "gold_forecasts")
    prices = store["gold_forecasts"].select(*SV.KEY, F.col("yhat").alias("price"))
    for _ in range(2):
        rows = D.gold_dispatch_rows(prices, "run-1", TM.at(CREATED))
        store.refresh(rows, "gold_dispatch", "created_at")
    return store["gold_dispatch"].groupBy("scenario_id", "run_id").agg(
        F.count(F.lit(1)).alias("hours"),
        F.min(HOUR).alias("first_hour"),
        F.max(HOUR).alias("last_hour"),
        F.sum("bid_mwh").alias("bid_total"),
    )


# serving ------------------------------------------------------------------------------------


@query(f"{HOUR}:s yhat:x yhat_lower:x yhat_upper:x")
def forecast_horizon_view(t):
    return S.forecast_horizon_view(t, AS_OF)


@query(
    f"{HOUR}:s price:x charge_mwh:x discharge_mwh:x soc_mwh:x bid_mwh:x expected_profit:x2",
)
def dispatch_horizon_view(t):
    return S.dispatch_horizon_view(t, MID_MONTH)


@query("avg_demand:x peak_demand:x min_demand:x data_points:l")
def forecast_cards(t):
    return S.forecast_cards(t, AS_OF)


@query(
    "total_charge_mwh:x total_discharge_mwh:x avg_soc_mwh:x total_profit:x2 avg_price:x"
    " round_trip_pct:x data_points:l",
)
def dispatch_cards(t):
    return S.dispatch_cards(t, MID_MONTH)


@query(
    "total_charge_mwh:x total_discharge_mwh:x avg_soc_mwh:x total_profit:x2 avg_price:x"
    " round_trip_pct:x data_points:l",
)
def dispatch_cards_fleet(t):
    return S.dispatch_cards(_fleet(t), MID_MONTH)


@query(
    f"{HOUR}:s price:x charge_mwh:x discharge_mwh:x soc_mwh:x bid_mwh:x expected_profit:x2",
)
def dispatch_horizon_view_fleet(t):
    return S.dispatch_horizon_view(_fleet(t), MID_MONTH)


@query("label:s charge_mwh:x discharge_mwh:x soc_mwh:x price:x")
def dispatch_chart(t):
    return S.dispatch_chart(t, MID_MONTH)


@query(
    "peak_hour:i peak_avg_mw:x min_hour:i min_avg_mw:x demand_range_mw:x latest_correlation:x"
    " correlation_label:s total_profit:x2 avg_soc_mwh:x total_rows:l data_start:ts data_end:ts",
)
def insights(t):
    return S.insights(t)


@query(
    "peak_hour:i peak_avg_mw:x min_hour:i min_avg_mw:x demand_range_mw:x latest_correlation:x"
    " correlation_label:s total_profit:x2 avg_soc_mwh:x total_rows:l data_start:ts data_end:ts",
)
def insights_fleet(t):
    return S.insights(_fleet(t))


@query(f"kind:s {HOUR}:ts value:x yhat_lower:x yhat_upper:x now_boundary:ts")
def actual_vs_forecast(t):
    return S.actual_vs_forecast(t)


@query(f"kind:s {HOUR}:ts value:x yhat_lower:x yhat_upper:x now_boundary:ts")
def actual_vs_forecast_runs(t):
    """Three stored runs: only the newest one is drawn."""
    return S.actual_vs_forecast(Replaced(t, gold_forecasts=t.forecasts_shifted_runs()))


@query(f"{HOUR}:s yhat:x yhat_lower:x yhat_upper:x")
def forecast_horizon_view_runs(t):
    """Three stored runs: each hour from the newest run that has it."""
    return S.forecast_horizon_view(Replaced(t, gold_forecasts=t.forecasts_shifted_runs()), AS_OF)


@query("avg_demand:x peak_demand:x min_demand:x data_points:l")
def forecast_cards_runs(t):
    return S.forecast_cards(Replaced(t, gold_forecasts=t.forecasts_shifted_runs()), AS_OF)


@query(
    "total_charge_mwh:x total_discharge_mwh:x avg_soc_mwh:x total_profit:x2 avg_price:x"
    " round_trip_pct:x data_points:l",
)
def dispatch_cards_runs(t):
    return S.dispatch_cards(Replaced(t, gold_dispatch=t.dispatch_runs()), MID_MONTH)


@query("profile:s position:i avg_demand_mw:x")
def profile_exploration(t):
    return S.profile_exploration(t)


@query(f"{HOUR}:ts temp_c:x demand_mw:x")
def temp_demand_pairs(t):
    return S.temp_demand_pairs(t)


@query(
    "forecast_start:ts forecast_end:ts avg_forecast_mw:x max_forecast_mw:x min_forecast_mw:x"
    " forecast_points:l min_actual_mw:x max_actual_mw:x"
)
def forecast_run_summary(t):
    return S.forecast_run_summary(t)


@query(
    "forecast_start:ts forecast_end:ts avg_forecast_mw:x max_forecast_mw:x min_forecast_mw:x"
    " forecast_points:l min_actual_mw:x max_actual_mw:x"
)
def forecast_run_summary_runs(t):
    return S.forecast_run_summary(Replaced(t, gold_forecasts=t.forecasts_shifted_runs()))


_LOADED = "row_count:l first_hour:ts last_hour:ts min_value:x max_value:x"


@query(_LOADED)
def load_summary(t):
    return S.load_summary(t["silver_demand_weather"], "demand_mw")


@query(_LOADED)
def load_summary_horizon(t):
    return S.load_summary(S.forecast_horizon(t, AS_OF), "yhat")


@query("series_id:s first_value:x last_value:x", series=SERIES)
def first_and_last(t):
    return S.first_and_last(A.known_demand(t), "demand_mw", by=["series_id"])


@query(f"series_id:s {HOUR}:ts demand_mw:x", series=SERIES)
def newest_rows(t):
    return K.newest_rows(t["silver_demand_weather"], 48, ["series_id"])


@query(f"{HOUR}:ts demand_mw:x")
def trailing_window(t):
    return G.within_days(t["bronze_demand"], AS_OF, 14)


@query(f"{HOUR}:ts yhat:x")
def current_horizon(t):
    return since(t["gold_forecasts"], TM.hour_of(AS_OF))


# exploration --------------------------------------------------------------------------------


@query("hour_of_day:i sun:x mon:x tue:x wed:x thu:x fri:x sat:x")
def hour_weekday_heatmap(t):
    return X.hour_weekday_heatmap(t)


_SPREAD = "position:i min_value:x q1:x median:x q3:x max_value:x"


@query(_SPREAD)
def demand_distribution_by_hour(t):
    return X.demand_distribution(t, "hour")


@query(_SPREAD)
def demand_distribution_by_weekday(t):
    return X.demand_distribution(t, "weekday")


@query(_SPREAD.replace("position:i", "position:d"))
def demand_distribution_by_date(t):
    return X.demand_distribution(t, "date")


@query(_SPREAD)
def demand_distribution_by_month(t):
    return X.demand_distribution(orders_as_demand(t), "month")


@query(f"series_id:s {HOUR}:ts demand_mw:x trend:x seasonal:x residual:x", series=SERIES)
def decompose(t):
    return X.decompose(t, by=["series_id"])


@query("left_column:s right_column:s correlation:x")
def corr_matrix(t):
    return X.corr_matrix(t)


@query("day_type:s hour_type:s avg_demand_mw:x hourly_readings:l")
def weekend_vs_weekday(t):
    return X.weekend_vs_weekday(t)


# nightly run and streams --------------------------------------------------------------------


@query(_OVERVIEW)
def nightly_refresh(t):
    """From landed files to gold tables; the overview counts what the run stored."""
    config = EngineConfig(new_folder(t.spark, "nightly"))
    demand = landing.land_demand(t, config.respondent)
    weather = landing.land_weather(t, config.station)
    nightly.nightly(t.spark, config, AS_OF, demand, weather)
    return A.table_overview(TableStore(t.spark, config.root))


@query("table_name:s rows_landed:l rows_rejected:l")
def feed_rejects(t):
    """Pages of which each also came torn: every torn page is one rejected row."""
    store = _store(t)
    path = landing.land_demand(t, "ERCO", torn=True)
    return ledger.ingest(store, "demand", path, lambda rows: feeds.readable(rows).count())


_FLEET_CONFIG = {"respondent": ("0", "1", "2", "3", "4"), "station": ("0", "1", "0", "1", "0")}


@query(
    f"series_id:s {HOUR}:ts demand_mw:x generation_mw:x temp_c:x wind_speed_mps:x", series=SERIES
)
def nightly_silver(t):
    """What a night stores for five respondents beside the weather of two stations."""
    store = _store(t)
    config = EngineConfig(store.root, **_FLEET_CONFIG, ledger=True)
    demand, weather = landing.land_demand(t), landing.land_weather(t)
    nightly.refresh_bronze_silver(t.spark, store, config, AS_OF, demand, weather)
    return store["silver_demand_weather"]


@query("series_id:s scenario_id:s hours:l first_hour:ts last_hour:ts bids:x3 broken:l", series=SERIES)
def nightly_gold(t):
    """Plans of three batteries for each of five respondents, and hours that break a rule."""
    store = _store(t)
    config = EngineConfig(store.root, **_FLEET_CONFIG)
    store.append(t["silver_demand_weather"], "silver_demand_weather")
    forecast = FC.seasonal_profile_forecast(store["silver_demand_weather"], profile="hour")
    store.refresh(FC.gold_forecast_rows(forecast, "run-1", TM.at(CREATED)), "gold_forecasts")
    nightly.dispatch_to_gold(store, config, AS_OF)
    units = t.spark.createDataFrame([vars(b) for b in D.FLEET])
    rows = store["gold_dispatch"].join(units, "scenario_id")
    broken = D.dispatch_check(rows).select("series_id", "scenario_id", HOUR, F.lit(1).alias("bad"))
    return rows.join(broken, ["series_id", "scenario_id", HOUR], "left").groupBy(
        "series_id", "scenario_id"
    ).agg(
        F.count(F.lit(1)).alias("hours"),
        F.min(HOUR).alias("first_hour"),
        F.max(HOUR).alias("last_hour"),
        F.sum("bid_mwh").alias("bids"),
        F.count("bad").alias("broken"),
    )


@query(f"series_id:s {_SILVER}", series=SERIES)
def silver_in_batches(t):
    """Silver after a stream of five files, the last with rows of all days, and weather in two parts."""
    store, folder = _store(t), new_folder(t.spark, "in")
    noon = F.dayofmonth(HOUR) <= 15
    store.refresh(t["bronze_weather"].where(noon), "bronze_weather", noted=True)
    late = F.col("event_id") % 10 == 0
    rows = t.of_type("click").select(
        "series_id", HOUR,
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("demand_mw"),
        F.when(F.col("event_id") % 5 != 0, N.derived_generation(F.col("value"))).alias("generation_mw"),
        F.col("ts").alias("loaded_at"),
        F.when(late, 0).otherwise(5 - F.floor(F.dayofmonth(HOUR) / 7)).alias("batch"),
    )
    for batch in range(5, 0, -1):
        part = rows.where(F.least("batch", F.lit(4)) == batch - 1).drop("batch")
        part.coalesce(1).write.mode("append").parquet(folder)
    schema = f"series_id string, {HOUR} timestamp, demand_mw double, generation_mw double, loaded_at timestamp"
    stream = ST.file_stream(t.spark, folder, schema, files=1)
    ST.refresh_tables(stream, store, "loaded_at", new_folder(t.spark, "stream")).awaitTermination()
    store.refresh(t["bronze_weather"].where(~noon), "bronze_weather", noted=True)
    upkeep.refresh_silver(store)
    return store["silver_demand_weather"]


@query(f"{HOUR}:ts demand_mw:x event_count:l")
def stream_hourly(t):
    session = ST.stream_session(t.spark, t.spark.sparkContext.defaultParallelism)
    stream = ST.file_stream(session, t.sf_dir, EVENTS, "events.parquet")
    stream = stream.withColumn("series_id", F.lit("all"))
    target = new_folder(t.spark, "hours")
    hours = ST.hourly_stream(stream)
    ST.write_hours(hours, target, new_folder(t.spark, "stream")).awaitTermination()
    schema = f"series_id string, {HOUR} timestamp, demand_mw double, event_count bigint"
    return t.spark.read.schema(schema).parquet(target)


@query(f"series_id:s {HOUR}:ts demand_mw:x loaded_at:ts", series=SERIES)
def stream_refresh_table(t):
    store = _store(t)
    stream = ST.file_stream(t.spark, t.sf_dir, EVENTS, "events.parquet")
    rows = stream.where(F.col("event_type") == "click").select(
        t.series_id.alias("series_id"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias(HOUR),
        F.col("value").alias("demand_mw"),
        F.col("ts").cast("timestamp").alias("loaded_at"),
    )
    run = ST.refresh_table(
        rows, store, "bronze_demand", "loaded_at", new_folder(t.spark, "stream")
    )
    run.awaitTermination()
    return store["bronze_demand"]
