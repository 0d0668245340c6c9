"""Grid, forward fill, moving means, silver, keys and quantiles against their plain forms."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourwatt.operators import analytics as A
from hourwatt.operators.frames import forward_fill, moving_means
from hourwatt.operators.grid import HOUR, future_hours, hour_grid
from hourwatt.operators.keys import latest_per_key, newest_rows
from hourwatt.operators.quantiles import exact_quantiles
from hourwatt.operators.silver import KEY, demand_clean, silver_build, weather_hourly
from hourwatt.sources.sample import SampleTables

START = datetime(2023, 12, 20, 5)


def hours(spark, n, gap=0.3, series=("a", "b"), seed=3):
    """Hourly rows over several months with missing rows and null values."""
    rng = random.Random(seed)
    rows = []
    for s in series:
        for i in range(n):
            if rng.random() > gap:
                value = None if rng.random() < gap else round(rng.uniform(0, 100), 2)
                rows.append((s, START + timedelta(hours=i), value))
    return spark.createDataFrame(rows, f"series_id string, {HOUR} timestamp, demand_mw double")


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_grid_has_every_hour_once(spark):
    df = hours(spark, 2000)
    counts = {
        r.series_id: (r.n, r.days)
        for r in hour_grid(df).groupBy("series_id").agg(
            F.count("*").alias("n"), F.count_distinct(HOUR).alias("days")
        ).collect()
    }
    for r in df.groupBy("series_id").agg(F.min(HOUR).alias("a"), F.max(HOUR).alias("b")).collect():
        span = int((r.b - r.a).total_seconds() // 3600) + 1
        assert counts[r.series_id] == (span, span)


def test_grid_of_one_hour(spark):
    df = spark.createDataFrame([("a", START)], f"series_id string, {HOUR} timestamp")
    assert rows_of(hour_grid(df), HOUR) == [("a", START)]


def test_future_hours(spark):
    got = future_hours(hours(spark, 50, gap=0), 3).where("series_id = 'a'").collect()
    assert sorted(r[HOUR] for r in got) == [START + timedelta(hours=49 + i) for i in (1, 2, 3)]


def test_forward_fill_equals_one_window(spark):
    df = hours(spark, 3000, gap=0.6)
    w = Window.partitionBy("series_id").orderBy(HOUR).rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("demand_mw", F.last("demand_mw", ignorenulls=True).over(w))
    got = forward_fill(df, ["demand_mw"])
    assert rows_of(got, *KEY) == rows_of(plain, *KEY)
    assert rows_of(forward_fill(got, ["demand_mw"]), *KEY) == rows_of(plain, *KEY)


def test_forward_fill_carries_over_empty_months_and_keeps_leading_nulls(spark):
    rows = [("a", START, None), ("a", START + timedelta(hours=1), 7.0)]
    rows += [("a", START + timedelta(days=30 * i), None) for i in (1, 2, 3, 4)]
    df = spark.createDataFrame(rows, f"series_id string, {HOUR} timestamp, demand_mw double")
    assert [r[2] for r in rows_of(forward_fill(df, ["demand_mw"]), HOUR)] == [None] + [7.0] * 5


@pytest.mark.parametrize("lo, hi", [(-23, 0), (-84, 83), (-1, -1), (1, 5), (0, 0), (5, 9)])
@pytest.mark.parametrize("nulls", [False, True])
def test_moving_means_equal_one_window(spark, lo, hi, nulls):
    df = hours(spark, 1500)
    df = df if nulls else df.where("demand_mw is not null")
    w = Window.partitionBy("series_id").orderBy(HOUR).rowsBetween(lo, hi)
    plain = rows_of(df.withColumn("m", F.avg("demand_mw").over(w)), *KEY)
    got = rows_of(moving_means(df, "demand_mw", {"m": (lo, hi)}, rows_per_run=200), *KEY)
    assert [r[:3] for r in got] == [r[:3] for r in plain]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in plain], abs=1e-9)


def test_moving_means_without_values(spark):
    df = hours(spark, 50).withColumn("demand_mw", F.lit(None).cast("double"))
    got = moving_means(df, "demand_mw", {"m": (-3, 0)})
    assert got.where("m is not null").isEmpty() and got.count() == df.count()


def test_newest_rolling_rows_equal_the_full_result(spark):
    tables = {"bronze_demand": hours(spark, 900)}
    for by in ([], ["series_id"]):
        if not by:
            tables = {"bronze_demand": hours(spark, 900, series=("a",))}
        full = A.rolling_averages(tables, by=by, limit=None)
        cut = A.rolling_averages(tables, by=by, limit=50)
        want = rows_of(full.orderBy(F.desc(HOUR), *by).limit(50), F.desc(HOUR), *by)
        got = rows_of(cut, F.desc(HOUR), *by)
        assert [r[:-2] for r in got] == [r[:-2] for r in want]
        assert np.allclose([r[-2:] for r in got], [r[-2:] for r in want])


def test_latest_per_key(spark):
    rows = [("a", 1, 1.0, 10), ("a", 1, None, 30), ("a", 1, 3.0, 20), ("b", 1, 5.0, 1)]
    df = spark.createDataFrame(rows, "k string, j int, v double, n int")
    want = [("a", 1, None, 30), ("b", 1, 5.0, 1)]
    assert rows_of(latest_per_key(df, ["k", "j"], ["n"]), "k") == want
    assert rows_of(latest_per_key(df, ["k", "j"], ["j", "n"]), "k") == want


def test_newest_rows_cut_before_the_shuffle(spark):
    df = hours(spark, 500)
    got = newest_rows(df, 5, ["series_id"])
    assert got.count() == 10
    assert "WindowGroupLimit" in got._jdf.queryExecution().toString()
    assert newest_rows(df, 5).count() == 5


def test_silver_properties(spark):
    t = SampleTables(spark, "/root/testdata/sf0.001", 3)
    silver = t["silver_demand_weather"]
    assert silver.groupBy(*KEY).count().where("count > 1").isEmpty()
    assert silver.count() == hour_grid(t["bronze_demand"]).count()


def test_silver_takes_the_newest_of_several_rows(spark):
    rows = [("a", START, 1.0, 1), ("a", START, 2.0, 2), ("a", START + timedelta(hours=3), 5.0, 1)]
    demand = spark.createDataFrame(
        rows, f"series_id string, {HOUR} timestamp, demand_mw double, load int"
    ).selectExpr("*", "demand_mw as generation_mw", "cast(null as double) as forecast_demand_mw")
    seen = [("a", START, 10.0, 1.0, 350.0), ("a", START, 20.0, 3.0, 20.0)]
    weather = spark.createDataFrame(
        seen,
        f"series_id string, {HOUR} timestamp, temp_c double, wind_speed_mps double,"
        " wind_dir_deg double",
    )
    got = rows_of(silver_build(demand, weather, newest="load"), HOUR)
    assert [r[2] for r in got] == [2.0, 2.0, 2.0, 5.0]
    assert [r[5:] for r in got] == [(15.0, 2.0, 5.0)] * 4


def test_two_stations_do_not_multiply_hours(spark):
    demand = spark.createDataFrame(
        [(s, START, 1.0) for s in "ab"], f"series_id string, {HOUR} timestamp, demand_mw double"
    ).selectExpr("*", "demand_mw as generation_mw", "cast(null as double) as forecast_demand_mw")
    weather = spark.createDataFrame(
        [("x", START, 10.0, 1.0, 0.0), ("y", START, 20.0, 1.0, 0.0)],
        f"series_id string, {HOUR} timestamp, temp_c double, wind_speed_mps double,"
        " wind_dir_deg double",
    )
    got = rows_of(silver_build(demand, weather, weather_by="hour"), *KEY)
    assert [r[5] for r in got] == [15.0, 15.0]


def test_demand_clean_derives_only_what_is_missing(spark):
    df = spark.createDataFrame(
        [("a", START, 100.0, 80.0), ("a", START + timedelta(hours=1), 100.0, None)],
        f"series_id string, {HOUR} timestamp, demand_mw double, generation_mw double",
    )
    got = rows_of(demand_clean(df, START + timedelta(days=2), 3), HOUR)
    assert [r[3] for r in got] == [80.0, 95.0]
    assert demand_clean(df, START + timedelta(days=9), 3).isEmpty()


def test_weather_hourly_without_any_direction(spark):
    df = spark.createDataFrame(
        [("a", START, 1.0, None, None)],
        f"series_id string, {HOUR} timestamp, temp_c double, wind_speed_mps double,"
        " wind_dir_deg double",
    )
    assert rows_of(weather_hourly(df), HOUR) == [("a", START, 1.0, None, None)]


def test_exact_quantiles_with_outliers_and_ties(spark):
    rng = np.random.default_rng(1)
    groups = {
        "bulk": np.concatenate([rng.normal(50, 1, 4000), [1e9, -1e9]]),
        "ties": np.array([5.0] * 999 + [6.0]),
        "one": np.array([3.5]),
        "two": np.array([1.0, 2.0]),
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    points = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    for r in exact_quantiles(df, "v", points, ["k"], slices=64).collect():
        want = np.quantile(groups[r.k], list(points.values()))
        assert np.allclose([r[p] for p in points], want, rtol=1e-12)
        assert (r.min_value, r.max_value) == (groups[r.k].min(), groups[r.k].max())


def test_peak_hour_tie_goes_to_the_earlier_hour(spark):
    day = datetime(2024, 1, 1)
    rows = [("a", day.replace(hour=h), v) for h, v in ((9, 8.0), (17, 8.0), (3, 1.0))]
    df = spark.createDataFrame(rows, f"series_id string, {HOUR} timestamp, demand_mw double")
    assert A.peak_days({"bronze_demand": df}).first().peak_hour == 9


def test_single_reading_has_no_spread(spark):
    df = spark.createDataFrame(
        [("a", START, 1.0)], f"series_id string, {HOUR} timestamp, demand_mw double"
    )
    assert A.daily_demand({"bronze_demand": df}).first().demand_stddev is None
    assert A.demand_outliers({"bronze_demand": df}).isEmpty()
