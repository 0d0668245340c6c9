from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourwatt.functions import numbers as N
from hourwatt.functions import times as TM


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    "text, hour",
    [
        ("2025-09-28T16", datetime(2025, 9, 28, 16)),
        ("20250928T16Z", datetime(2025, 9, 28, 16)),
        ("yesterday", None),
    ],
)
def test_feed_hour(spark, text, hour):
    assert one(spark, TM.feed_hour(F.col("t")), t=text) == hour


def test_naive_drops_the_zone(spark):
    at = datetime(2024, 5, 1, 7, 30)
    assert one(spark, TM.naive(F.col("t")), t=at) == at
    assert spark.range(1).select(TM.naive(F.current_timestamp()).alias("x")).dtypes == [("x", "timestamp_ntz")]


@pytest.mark.parametrize(
    "text, number",
    [("abc", None), ("", None), ("1d", None), ("NaN", None), ("12.5", 12.5), ("-3e2", -300.0)],
)
def test_to_number(spark, text, number):
    assert one(spark, N.to_number(F.col("t")), t=text) == number


@pytest.mark.parametrize(
    "code, temp",
    [("+0200,1", 20.0), ("-0050,1", -5.0), ("+9999,9", None), ("", None), ("12.5,1", None)],
)
def test_station_temp(spark, code, temp):
    assert one(spark, N.station_temp(F.col("t")), t=code) == temp


def test_station_sentinels_can_be_kept(spark):
    assert one(spark, N.station_temp(F.col("t"), True), t="+9999,9") == 999.9
    assert one(spark, N.station_wind_speed(F.col("t"), True), t="999,9,9,9999,9") == 999.9
    assert one(spark, N.station_wind_dir(F.col("t"), True), t="999,9,9,9999,9") == 999.0
    assert one(spark, N.station_wind_speed(F.col("t")), t="999,9,9,9999,9") is None
    assert one(spark, N.station_wind_dir(F.col("t")), t="999,9,9,9999,9") is None


@pytest.mark.parametrize(
    "code, speed, bearing", [("170,1,N,0021,1", 2.1, 170.0), ("170,1", None, 170.0)]
)
def test_station_wind(spark, code, speed, bearing):
    assert one(spark, N.station_wind_speed(F.col("t")), t=code) == speed
    assert one(spark, N.station_wind_dir(F.col("t")), t=code) == bearing


@pytest.mark.parametrize(
    "temp, name", [(9.99, N.COLD), (10.0, N.MODERATE), (25.0, N.MODERATE), (25.01, N.HOT)]
)
def test_temp_bucket_edges(spark, temp, name):
    assert one(spark, N.temp_bucket(F.col("t")), t=temp) == name


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(10.0, 1.0), (10.0, 2.0), (10.0, 3.0)], ["a", "b"])
    assert df.agg(N.correlation(F.col("a"), F.col("b")).alias("r")).first().r is None


def test_correlation_uses_rows_with_both_values(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (9.0, None), (None, 1.0)], "a double, b double"
    )
    assert df.agg(N.correlation(F.col("a"), F.col("b")).alias("r")).first().r == pytest.approx(1.0)


def test_mean_direction_crosses_north(spark):
    df = spark.createDataFrame([(350.0,), (20.0,)], ["d"])
    assert df.agg(N.mean_direction(F.col("d")).alias("m")).first().m == pytest.approx(5.0)


@pytest.mark.parametrize(
    "r, label",
    [(0.51, "Strong"), (-0.51, "Strong"), (0.5, "Moderate"), (0.31, "Moderate"), (0.3, "Weak")],
)
def test_strength_label(spark, r, label):
    assert one(spark, N.strength_label(F.col("r")), r=r) == label


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "x double")
    assert [r.y for r in df.select(N.clamp_zero(F.col("x")).alias("y")).collect()] == [0, 2, None]


def test_percent_of_nothing_is_null(spark):
    assert one(spark, N.percent(F.col("a"), F.col("b")), a=1.0, b=0.0) is None


@pytest.mark.parametrize(
    "text, label",
    [
        ("2024-01-31T05:00:00Z", "2024-01-31 05:00:00"),
        ("2024-01-31T05:00:00", "2024-01-31 05:00:00"),
        ("2024-01-31 05:00:00", "2024-01-31 05:00:00"),
        ("soon", "Invalid Date"),
    ],
)
def test_display_label(spark, text, label):
    assert one(spark, TM.display_label(F.col("t")), t=text) == label


def test_calendar(spark):
    sunday = F.lit("2024-01-07 23:10:00").cast("timestamp")
    assert one(spark, TM.day_of_week(sunday)) == 1
    assert one(spark, TM.weekday(sunday)) == 6
    assert one(spark, TM.day_name(sunday)) == "Sunday"
    assert one(spark, TM.hour_of_week(sunday)) == 167
