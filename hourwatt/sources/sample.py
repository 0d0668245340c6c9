"""The five tables, and raw feed rows, mapped from the ``events`` and ``orders`` test tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourwatt.functions import numbers as N
from hourwatt.functions import times as TM
from hourwatt.operators.grid import HOUR
from hourwatt.operators.forecast import seasonal_profile_forecast
from hourwatt.operators.silver import silver_build
from hourwatt.session import pin_utc

AS_OF = datetime(2024, 1, 31, 12, 34)
CREATED = datetime(2024, 1, 31)
BACKTEST_CUT = datetime(2024, 1, 29)
ONE_SERIES = "all"

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
ORDERS = "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz"


class SampleTables(Mapping):
    """Lazy tables by name; ``series`` splits the events into that many series by user."""

    def __init__(self, spark: SparkSession, sf_dir: str, series: int = 1):
        self.spark = pin_utc(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self.series = series
        self._built: dict[str, DataFrame] = {}

    _makers = {
        "bronze_demand": "_bronze_demand",
        "bronze_weather": "_bronze_weather",
        "silver_demand_weather": "_silver",
        "gold_forecasts": "_gold_forecasts",
        "gold_dispatch": "_gold_dispatch",
    }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = getattr(self, self._makers[name])()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    # raw rows -------------------------------------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        df = self.spark.read.schema(EVENTS).parquet(f"{self.sf_dir}/events.parquet")
        return df.withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def orders(self) -> DataFrame:
        return self.spark.read.schema(ORDERS).parquet(f"{self.sf_dir}/orders.parquet")

    @property
    def series_id(self) -> Column:
        if self.series == 1:
            return F.lit(ONE_SERIES)
        return (F.col("user_id") % self.series).cast("string")

    def of_type(self, *types: str) -> DataFrame:
        df = self.events.where(F.col("event_type").isin(*types))
        return df.withColumn("series_id", self.series_id).withColumn(
            HOUR, F.date_trunc("hour", "ts")
        )

    def demand_raw(self) -> DataFrame:
        """One row per event: several rows for one hour, the latest event is the newest load."""
        return self.of_type("click").select(
            "series_id",
            HOUR,
            F.col("value").alias("demand_mw"),
            N.derived_generation(F.col("value")).alias("generation_mw"),
            N.null_double().alias("forecast_demand_mw"),
            F.col("event_id").alias("load_no"),
        )

    def weather_raw(self) -> DataFrame:
        return self.weather_raw_numbered().drop("event_id")

    def weather_raw_numbered(self) -> DataFrame:
        """Observation codes with sentinels, empty temperatures and short wind codes."""
        tenths = F.lpad(F.floor("value").cast("int").cast("string"), 4, "0")
        bearing = F.lpad((F.col("user_id") % 360).cast("string"), 3, "0")
        number = F.col("event_id")
        return self.of_type("view").select(
            "event_id",
            F.col("series_id").alias("STATION"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
            F.when(number % 50 == 0, "+9999,9")
            .when(number % 77 == 0, "")
            .otherwise(F.concat(F.lit("+"), tenths, F.lit(",1")))
            .alias("TMP"),
            F.when(number % 61 == 0, "170,1")
            .otherwise(F.concat(bearing, F.lit(",1,N,"), tenths, F.lit(",1")))
            .alias("WND"),
        )

    # the five tables ------------------------------------------------------------------------

    def _bronze_demand(self) -> DataFrame:
        total = F.sum("value") - 5
        hours = self.of_type("click").groupBy("series_id", HOUR).agg(
            F.nullif(F.greatest(total, F.lit(0.0)), F.lit(0.0)).alias("demand_mw")
        )
        return hours.withColumns(
            {
                "generation_mw": N.derived_generation(F.col("demand_mw")),
                "forecast_demand_mw": N.null_double(),
            }
        )

    def _bronze_weather(self) -> DataFrame:
        return self.of_type("view").groupBy("series_id", HOUR).agg(
            (F.avg("value") * 0.6 - 5).alias("temp_c"),
            (F.avg("value") / 10).alias("wind_speed_mps"),
            F.avg(F.col("user_id") % 360).alias("wind_dir_deg"),
        )

    def _silver(self) -> DataFrame:
        return silver_build(self["bronze_demand"], self["bronze_weather"])

    def _gold_forecasts(self) -> DataFrame:
        rows = seasonal_profile_forecast(self["silver_demand_weather"], profile="hour")
        return rows.withColumns(
            {"run_id": F.lit("run-1"), "created_at": TM.at(CREATED)}
        )

    def forecasts_two_runs(self) -> DataFrame:
        """The forecast as written by two nights; the second night says ten percent more."""
        first = self["gold_forecasts"]
        more = {c: F.col(c) * 1.1 for c in ("yhat", "yhat_lower", "yhat_upper")}
        second = first.withColumns(
            {
                **more,
                "run_id": F.lit("run-2"),
                "created_at": F.col("created_at") + F.expr("INTERVAL 1 DAY"),
            }
        )
        return first.unionByName(second)

    def forecasts_shifted_runs(self) -> DataFrame:
        """Three nights, a day apart: the first without ``created_at``, the others with the same one."""
        nights = [("run-1", 0, 1.0, None), ("run-2", 1, 1.1, CREATED), ("run-3", 2, 1.2, CREATED)]
        rows = []
        for run, days, factor, created in nights:
            rows.append(
                self["gold_forecasts"].withColumns(
                    {
                        HOUR: F.col(HOUR) + F.expr(f"INTERVAL {days} DAY"),
                        **{c: F.col(c) * factor for c in ("yhat", "yhat_lower", "yhat_upper")},
                        "run_id": F.lit(run),
                        "created_at": TM.at(created) if created else F.lit(None).cast("timestamp"),
                    }
                )
            )
        return rows[0].unionByName(rows[1]).unionByName(rows[2])

    def dispatch_runs(self) -> DataFrame:
        """An old run without ``created_at``, then a run of two batteries 40 days later."""
        old = self["gold_dispatch"].withColumn("created_at", F.lit(None).cast("timestamp"))
        new = self["gold_dispatch"].withColumns(
            {
                HOUR: F.col(HOUR) + F.expr("INTERVAL 40 DAY"),
                "run_id": F.lit("run-2"),
                "soc_mwh": F.col("soc_mwh") / 2,
            }
        )
        other = new.withColumns(
            {"scenario_id": F.lit("other"), "charge_mwh": F.col("charge_mwh") / 4}
        )
        return old.unionByName(new).unionByName(other)

    def dispatch_fleet(self) -> DataFrame:
        """Three batteries that trade the same prices: alternatives to each other."""
        base, rows = self["gold_dispatch"], []
        for name, part in (("unit", 0.01), ("large", 2.0)):
            sized = ("charge_mwh", "discharge_mwh", "soc_mwh", "hour_profit", "expected_profit")
            rows.append(
                base.withColumns({"scenario_id": F.lit(name)} | {c: F.col(c) * part for c in sized})
            )
        return base.unionByName(rows[0]).unionByName(rows[1])

    def _gold_dispatch(self) -> DataFrame:
        def total(kind: str) -> Column:
            return F.sum(F.when(F.col("event_type") == kind, F.col("value")).otherwise(0.0))

        hours = self.of_type("click", "purchase", "signup", "error").groupBy("series_id", HOUR)
        rows = hours.agg(
            total("click").alias("price"),
            F.least(total("purchase") / 10, F.lit(50.0)).alias("charge_mwh"),
            F.least(total("signup") / 10, F.lit(50.0)).alias("discharge_mwh"),
            F.least(total("error") / 5, F.lit(100.0)).alias("soc_mwh"),
        ).withColumn("bid_mwh", N.clamp_zero(F.col("price")) / 0.02)
        rows = rows.withColumn(
            "hour_profit",
            F.col("price") * (F.col("discharge_mwh") - F.col("charge_mwh") + F.col("bid_mwh")),
        )
        run_total = rows.groupBy("series_id").agg(F.sum("hour_profit").alias("expected_profit"))
        return rows.join(run_total, "series_id").withColumns(
            {
                "scenario_id": F.lit("base"),
                "run_id": F.lit("run-1"),
                "status": F.lit("optimal"),
                "created_at": TM.at(CREATED),
            }
        )

    def order_months(self) -> DataFrame:
        """Order totals as demand: several years of months."""
        return self.orders.select(
            F.lit(ONE_SERIES).alias("series_id"),
            F.col("o_orderdate").cast("timestamp").alias(HOUR),
            F.col("o_totalprice").alias("demand_mw"),
        )
