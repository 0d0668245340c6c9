"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. The
five tables of each number of series are stored once, with ``TableStore``; the queries read them
from there, so that operators are timed and not the mapping of the test data. Each query runs twice
and the faster run counts, so that compiling plans is not what is timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402

from hourwatt.operators.analytics import ALL_TABLES  # noqa: E402
from hourwatt.plans import registry  # noqa: E402
from hourwatt.session import build_session  # noqa: E402
from hourwatt.sources.sample import SampleTables  # noqa: E402
from hourwatt.sources.store import TableStore  # noqa: E402

HEADLINE = (
    "table_overview daily_demand hourly_profile weekday_profile monthly_demand temp_demand_corr"
    " temp_bucket_impact missing_data demand_outliers mom_growth peak_days rolling_averages"
    " rolling_averages_all_rows volatility_days latest_per_key silver_build"
    " silver_build_by_series weather_clean demand_distribution_by_hour decompose corr_matrix"
    " forecast_daily seasonal_profile_forecast additive_forecast forecast_accuracy dispatch_daily"
    " dispatch_summary battery_dispatch generation_dispatch merit_order actual_vs_forecast"
    " forecast_horizon_view dispatch_horizon_view forecast_cards dispatch_cards"
).split()


class StoredTables(SampleTables):
    """The mapped tables, read from a store."""

    stores: dict[int, TableStore] = {}

    def __getitem__(self, name: str) -> DataFrame:
        store = self.stores.get(self.series)
        if store is None or self.sf_dir != self.home:
            return super().__getitem__(name)
        return store[name]

    def days(self, name: str) -> list:
        """Days of a stored table; reports of the newest days read those alone."""
        store = self.stores.get(self.series)
        return [] if store is None or self.sf_dir != self.home else store.days(name)

    home = ""


def store_tables(spark, sf_dir: str, folder: str) -> None:
    for series in (1, registry.SERIES):
        tables, store = SampleTables(spark, sf_dir, series), TableStore(spark, f"{folder}/{series}")
        for name in ALL_TABLES:
            store.append(tables[name], name)
        StoredTables.stores[series] = store
    StoredTables.home = sf_dir.rstrip("/")
    registry.SampleTables = StoredTables


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "hourwatt-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__checkpoint__dir=f"{folder}/shared",
    )
    spark.sparkContext.setLogLevel("ERROR")
    store_tables(spark, sf_dir, folder)
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            found = registry.REGISTRY[name].run(spark, sf_dir)
            found.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries on stored tables, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
