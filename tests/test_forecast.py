from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourwatt.operators import additive, forecast
from hourwatt.operators import explore as X
from hourwatt.operators.additive import Model
from hourwatt.operators.forecast import (
    additive_forecast,
    normal_equations,
    seasonal_profile_forecast,
)
from hourwatt.operators.grid import HOUR

START = datetime(2024, 1, 1)


def seasonal(spark, days=60, noise=1.0, slope=0.02, series=("a", "b"), seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for s in series:
        for i in range(days * 24):
            y = 100 + slope * i + 20 * np.sin(2 * np.pi * i / 24) + 8 * np.cos(2 * np.pi * i / 168)
            rows.append((s, START + timedelta(hours=i), float(y + noise * rng.normal())))
    return spark.createDataFrame(rows, f"series_id string, {HOUR} timestamp, demand_mw double")


def test_hours_and_band(spark):
    df = seasonal(spark)
    for r in additive_forecast(df, 48).groupBy("series_id").agg(
        F.min(HOUR).alias("a"), F.max(HOUR).alias("b"), F.count_distinct(HOUR).alias("n"),
        F.bool_and((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper")))
        .alias("ok"),
    ).collect():
        assert (r.a, r.b, r.n, r.ok) == (
            START + timedelta(days=60), START + timedelta(days=60, hours=47), 48, True,
        )


def test_better_than_the_profile_on_a_trend(spark):
    df = seasonal(spark)
    cut = START + timedelta(days=58)
    past = df.where(F.col(HOUR) < F.lit(cut))
    errors = [
        X.forecast_accuracy(df, f).first().rmse
        for f in (additive_forecast(past), seasonal_profile_forecast(past, profile="hour_of_week"))
    ]
    assert errors[0] < errors[1]
    assert errors[0] < 3


@pytest.mark.parametrize("model", [Model(), Model(yearly=True), Model(weekly=False, hinges=0)])
def test_short_and_constant_histories(spark, model):
    rows = [("one", START, 5.0)] + [("flat", START + timedelta(hours=i), 7.0) for i in range(48)]
    df = spark.createDataFrame(rows, f"series_id string, {HOUR} timestamp, demand_mw double")
    got = additive_forecast(df, 3, model).collect()
    assert len(got) == 6
    assert all(np.isfinite(r.yhat) for r in got)
    assert all(r.yhat == pytest.approx(7.0, abs=0.2) for r in got if r.series_id == "flat")


def test_repeated_rows_count_as_weights(spark):
    df = seasonal(spark, 20, series=("a",))
    once = {r[HOUR]: r.yhat for r in additive_forecast(df).collect()}
    twice = {r[HOUR]: r.yhat for r in additive_forecast(df.union(df)).collect()}
    assert all(once[h] == pytest.approx(twice[h], rel=0.02) for h in once)


def test_history_window(spark):
    df = seasonal(spark, 30, series=("a",))
    as_of = START + timedelta(days=30)
    cut = additive_forecast(df, as_of=as_of, history_days=10)
    same = additive_forecast(df.where(F.col(HOUR) >= F.lit(as_of - timedelta(days=10))))
    assert sorted(r.yhat for r in cut.collect()) == pytest.approx(
        sorted(r.yhat for r in same.collect())
    )


def direct_fit(hours, y, w, horizon, model):
    """The whole design matrix at once."""
    first, span = hours.min(), max(hours.max() - hours.min(), 1.0)
    scale = np.abs(y).max()
    x, widths = additive._design(hours.astype(float), first, span, model)
    gram, right = x.T @ (w[:, None] * x), x.T @ (w * y / scale)

    def spread(beta):
        return np.sqrt((w * (y / scale - x @ beta) ** 2).sum() / max(w.sum() - x.shape[1], 1.0))

    beta = np.linalg.lstsq(gram, right, rcond=1e-12)[0]
    beta = np.linalg.lstsq(gram + np.diag(spread(beta) ** 2 / widths**2), right, rcond=1e-12)[0]
    ahead = np.arange(1, horizon + 1) + hours.max()
    yhat = additive._design(ahead.astype(float), first, span, model)[0] @ beta * scale
    return yhat, additive.BAND_Z * spread(beta) * scale


@pytest.mark.parametrize("model", [Model(), Model(yearly=True)])
def test_chunks_of_a_long_series_give_the_whole_fit(spark, model, monkeypatch):
    monkeypatch.setattr(forecast, "CHUNK", 500)
    df = seasonal(spark, 400, series=("a",))
    rows = df.orderBy(HOUR).collect()
    hours = np.array([int(r[HOUR].timestamp()) // 3600 for r in rows])
    y = np.array([r.demand_mw for r in rows])
    yhat, half = direct_fit(hours, y, np.ones(len(y)), 48, model)
    got = additive_forecast(df, 48, model, history_days=None).orderBy(HOUR).collect()
    assert [r.yhat for r in got] == pytest.approx(list(yhat), rel=1e-6)
    assert [r.yhat_upper - r.yhat for r in got] == pytest.approx([half] * 48, rel=1e-6)
    assert normal_equations(df, model, history_days=None).count() == 1


def test_series_that_ended_long_ago_keep_their_forecast(spark):
    rows = [
        (s, START + timedelta(days=d, hours=i), 100.0 + i % 24)
        for s, d in (("old", 0), ("new", 800)) for i in range(24 * 20)
    ]
    df = spark.createDataFrame(rows, f"series_id string, {HOUR} timestamp, demand_mw double")
    got = additive_forecast(df).groupBy("series_id").agg(F.min(HOUR), F.count(F.lit(1))).collect()
    assert {tuple(r) for r in got} == {
        ("old", START + timedelta(days=20), 48), ("new", START + timedelta(days=820), 48)
    }


def test_profile_falls_back_to_the_hour(spark):
    rows = [("a", START + timedelta(hours=i), float(i % 24)) for i in range(72)]
    df = spark.createDataFrame(rows, f"series_id string, {HOUR} timestamp, demand_mw double")
    got = seasonal_profile_forecast(df, 24).collect()
    assert {r[HOUR].hour: r.yhat for r in got} == {h: float(h) for h in range(24)}


def test_accuracy_ignores_missing_previous_hour(spark):
    schema = f"{HOUR} timestamp, demand_mw double"
    actual = spark.createDataFrame(
        [(START, 10.0), (START + timedelta(hours=1), 12.0), (START + timedelta(hours=3), 0.0)],
        schema,
    )
    planned = spark.createDataFrame(
        [(START + timedelta(hours=i), 10.0 + i, 9.0 + i, 11.0 + i) for i in range(4)],
        f"{HOUR} timestamp, yhat double, yhat_lower double, yhat_upper double",
    )
    got = X.forecast_accuracy(actual, planned).first()
    assert got.points == 3 and got.direction_pct == 100.0
    assert got.mape_pct == pytest.approx(100 / 12 / 2)
    assert got.coverage_pct == pytest.approx(200 / 3)
