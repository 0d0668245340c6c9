"""Dispatch against a fine grid of levels, and its rules."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourwatt.operators import dispatch as D
from hourwatt.operators import storage
from hourwatt.operators.grid import HOUR

START = datetime(2024, 1, 1)


def grid_value(prices, size, power, eta_c, eta_d, points=801):
    """Best trading value when levels are limited to a grid: never above the optimum."""
    levels = np.linspace(0, size, points)
    step = levels[None, :] - levels[:, None]  # from row to column
    value = np.zeros(points)
    for p in reversed(prices):
        # For a change, discharge as much as possible or as little, whichever pays more.
        d_low = np.maximum(-step * eta_d, 0.0)
        c_low = np.maximum(step / eta_c, 0.0)
        d_high = np.minimum(power, (eta_c * power - step) * eta_d)
        c_high = (step + d_high / eta_d) / eta_c
        ok = (d_low <= power + 1e-9) & (c_low <= power + 1e-9)
        gain = np.maximum(p * (d_low - c_low), p * (d_high - c_high))
        value = np.where(ok, gain + value[None, :], -np.inf).max(axis=1)
    return value[np.argmin(np.abs(levels - size / 2))]


def battery(prices, *setting):
    """One scenario: (charge, discharge, levels), or None."""
    setting = [np.array([float(x)]) for x in setting]
    *plan, ok = storage.battery_hours(np.array([prices], dtype=float), *setting)
    return [x[0] for x in plan] if ok[0] else None


def supply(demands, *setting):
    *plan, ok = storage.supply_hours(np.array([demands], dtype=float), *setting)
    return [x[0] for x in plan] if ok[0] else None


def traded(prices, plan):
    charge, discharge, _ = plan
    return float(np.dot(prices, np.array(discharge) - np.array(charge)))


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize(
    "unit", [(100, 50, 0.95, 0.95), (1, 1, 0.95, 0.95), (200, 25, 0.9, 0.9), (100, 50, 1, 1)]
)
def test_battery_reaches_the_grid_optimum(seed, unit):
    prices = np.random.default_rng(seed).uniform(-30, 100, 12)
    plan = battery(prices, *unit, unit[0] / 2)
    best, grid = traded(prices, plan), grid_value(prices, *unit)
    assert best >= grid - 1e-6
    assert best <= grid + 0.01 * abs(grid) + unit[0] * 0.5


@pytest.mark.parametrize("seed", range(20))
def test_battery_obeys_its_rules(seed):
    rng = np.random.default_rng(seed)
    prices = rng.uniform(-50, 100, int(rng.integers(1, 60)))
    size, power, eta_c, eta_d = 100.0, rng.uniform(5, 150), rng.uniform(0.7, 1), rng.uniform(0.7, 1)
    charge, discharge, levels = map(
        np.array, battery(prices, size, power, eta_c, eta_d, size / 2)
    )
    before = np.concatenate([[size / 2], levels[:-1]])
    assert np.allclose(levels, before + eta_c * charge - discharge / eta_d, atol=1e-9)
    assert levels.min() >= -1e-9 and levels.max() <= size + 1e-9
    for x in (charge, discharge):
        assert x.min() >= -1e-9 and x.max() <= power + 1e-9


def test_scenarios_do_not_touch_each_other():
    rng = np.random.default_rng(11)
    prices = rng.uniform(-50, 100, (40, 24))
    unit = [rng.uniform(a, b, 40) for a, b in ((10, 200), (5, 60), (0.7, 1), (0.7, 1))]
    together = storage.battery_hours(prices, *unit, unit[0] / 2)
    for i in range(40):
        alone = battery(prices[i], *[u[i] for u in unit], unit[0][i] / 2)
        for x, y in zip(alone, together):
            assert np.allclose(x, y[i], atol=1e-9)


def test_negative_price_on_a_full_battery_pays_for_losses():
    charge, discharge, levels = battery([-10.0], 100.0, 50.0, 0.9, 0.9, 100.0)
    assert charge[0] == pytest.approx(50) and discharge[0] == pytest.approx(40.5)
    assert levels[0] == pytest.approx(100)


def grid_cost(demands, caps, costs, power, eta_c, low, high, start, points=901):
    levels = np.linspace(low, high, points)
    step = levels[None, :] - levels[:, None]
    charge, discharge = np.maximum(step, 0) / eta_c, np.maximum(-step, 0)
    ok = (charge <= power + 1e-9) & (discharge <= power + 1e-9)
    value = np.zeros(points)
    for x in reversed(demands):
        net, cost, below = x + charge - discharge, 0.0, 0.0
        for cap, price in zip(caps, costs):
            cost = cost + np.clip(net - below, 0, cap) * price
            below += cap
        cost = np.where(ok & (net <= below + 1e-9), cost, np.inf)
        value = (cost + value[None, :]).min(axis=1)
    return value[np.argmin(np.abs(levels - start))]


def supply_cost(demands, plan, caps, costs):
    charge, discharge, _ = map(np.array, plan)
    net, cost, below = np.array(demands) + charge - discharge, 0.0, 0.0
    for cap, price in zip(caps, costs):
        cost += (np.clip(net - below, 0, cap) * price).sum()
        below += cap
    assert (net <= below + 1e-6).all()
    return cost


@pytest.mark.parametrize("seed", range(25))
def test_generation_reaches_the_grid_optimum(seed):
    demands = np.random.default_rng(seed).uniform(100, 1700, 8)
    caps, costs = np.array([300.0, 500.0, 800.0]), np.array([0.03, 0.05, 0.08])
    setting = (200.0, 0.9, 10.0, 100.0, 50.0)  # power, efficiency, lowest, highest, first level
    plan = supply(demands, caps, costs, *setting)
    grid = grid_cost(demands, caps, costs, *setting)
    if plan is None:
        assert not np.isfinite(grid)
        return
    charge, discharge, levels = map(np.array, plan)
    before = np.concatenate([[50.0], levels[:-1]])
    assert np.allclose(levels, before + 0.9 * charge - discharge, atol=1e-9)
    assert levels.min() >= 10 - 1e-9 and levels.max() <= 100 + 1e-9
    cost = supply_cost(demands, plan, caps, costs)
    assert cost <= grid + 1e-6
    assert cost >= grid - 0.02 * max(abs(grid), 1)


def test_too_much_demand_is_infeasible():
    caps, costs = np.array([300.0, 500.0, 800.0]), np.array([0.03, 0.05, 0.08])
    assert supply([50_000.0], caps, costs, 200.0, 0.9, 0.1, 1.0, 0.5) is None
    assert supply([1600.4], caps, costs, 200.0, 0.9, 0.1, 1.0, 0.5) is not None
    assert supply([1600.41], caps, costs, 200.0, 0.9, 0.1, 1.0, 0.5) is None


def prices(spark, n=30, series=("a", "b")):
    rng = np.random.default_rng(7)
    rows = [
        (s, START + timedelta(hours=i), float(v))
        for s in series
        for i, v in enumerate(rng.uniform(-20, 100, n))
    ]
    return spark.createDataFrame(rows, f"series_id string, {HOUR} timestamp, price double")


def test_dispatch_passes_its_own_check(spark):
    solved = D.battery_dispatch(prices(spark))
    assert solved.count() == 2 * 3 * 30
    assert D.dispatch_check(solved).isEmpty()
    broken = solved.withColumn("soc_mwh", F.col("soc_mwh") + 1)
    assert not D.dispatch_check(broken).isEmpty()


def test_dispatch_horizon_and_profit(spark):
    solved = D.dispatch_profit(D.battery_dispatch(prices(spark), horizon=12))
    assert solved.count() == 2 * 3 * 12
    for r in solved.groupBy("series_id", "scenario_id").agg(
        F.sum("hour_profit").alias("s"), F.max("expected_profit").alias("t")
    ).collect():
        assert r.s == pytest.approx(r.t)
    bids = solved.where("price < 0").agg(F.max("bid_mwh")).first()[0]
    assert bids == 0


def test_every_hour_has_a_plan_by_default(spark):
    assert D.battery_dispatch(prices(spark, 100)).count() == 2 * 3 * 100
    loads = prices(spark, 100).withColumn("demand_mw", F.lit(500.0))
    assert D.generation_dispatch(loads).count() == 200


def test_gold_rows_solve_once_and_sum_their_profits(spark):
    rows = D.gold_dispatch_rows(prices(spark), "run", F.current_timestamp())
    for r in rows.groupBy("series_id", "scenario_id").agg(
        F.sum("hour_profit").alias("s"), F.max("expected_profit").alias("t")
    ).collect():
        assert r.s == pytest.approx(r.t)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_impossible_horizons_cost_infinitely_much(spark):
    loads = prices(spark, 4).withColumn("demand_mw", F.when(F.col("series_id") == "a", 1700.0).otherwise(100.0))
    for r in D.dispatch_feasibility(loads).collect():
        assert (r.status, r.cost == float("inf")) == (("infeasible", True) if r.series_id == "a" else ("optimal", False))


def test_batteries_of_a_table_trade_their_own_series(spark):
    fleet = spark.createDataFrame(
        [("a", "one", 10.0, 5.0, 0.9, 0.9, 0.01)],
        "series_id string, scenario_id string, s_max double, p_max double, eta_c double,"
        " eta_d double, lam double",
    )
    solved = D.battery_dispatch(prices(spark), fleet)
    assert {r.series_id for r in solved.select("series_id").distinct().collect()} == {"a"}
    assert D.dispatch_check(solved).isEmpty()


def test_missing_price_has_no_plan_but_keeps_its_rows(spark):
    df = prices(spark, 4, ("a",)).withColumn("price", F.when(F.hour(HOUR) != 2, F.col("price")))
    got = D.battery_dispatch(df, D.FLEET[:1]).collect()
    assert len(got) == 4
    assert {r.status for r in got} == {"infeasible"} and {r.charge_mwh for r in got} == {None}


def test_merit_order_rows(spark):
    rows = [(-5.0,), (100.0,), (700.0,), (1700.0,), (None,)]
    df = spark.createDataFrame(rows, "demand_mw double")
    got = [tuple(r) for r in D.merit_order(df).collect()]
    assert got[0] == (-5.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    assert got[1][1:4] == (100.0, 0.0, 0.0)
    assert got[2][1:4] == (300.0, 400.0, 0.0)
    assert got[3][1:4] == (300.0, 500.0, 800.0) and got[3][5] == 100.0
    assert got[4] == (None,) * 6


def test_generation_dispatch_serves_net_load(spark):
    df = prices(spark).withColumn("demand_mw", F.abs("price") * 15)
    got = D.generation_dispatch(df, store=D.Store(low=10.0, high=100.0, start=50.0))
    assert got.count() == 60
    for r in got.collect():
        assert r.status == "optimal"
        made = r.wind_mw + r.solar_mw + r.gas_mw
        assert made + 1e-6 >= r.demand_mw + r.charge_mwh - r.discharge_mwh


def price_path(spark, hours, seed, series="ab", season=True):
    rng = np.random.default_rng(seed)
    rows = []
    for s in series:
        wave = 20 * np.sin(np.arange(hours) * 2 * np.pi / 24) if season else 0
        path = 30 + wave + rng.normal(0, 12, hours)
        rows += [(s, START + timedelta(hours=i), float(p)) for i, p in enumerate(path)]
    return spark.createDataFrame(rows, f"series_id string, {HOUR} timestamp, price double")


def plan_values(df):
    earned = F.col("price") * (F.col("discharge_mwh") - F.col("charge_mwh"))
    found = df.groupBy("series_id", "scenario_id").agg(F.sum(earned).alias("v"), F.count("soc_mwh").alias("n"))
    return {(r.series_id, r.scenario_id): (r.v, r.n) for r in found.collect()}


@pytest.mark.parametrize("hours, block", [(300, 24), (300, 7), (25, 100), (1, 5)])
def test_blocks_of_a_horizon_give_the_whole_plan(spark, hours, block):
    fleet = [*D.FLEET, D.Battery("slow", 500.0, 3.0, 0.8, 0.9)]
    prices = price_path(spark, hours, hours + block)
    whole, split = D.battery_dispatch(prices, fleet), D.long_battery_dispatch(prices, fleet, block=block)
    assert split.columns == whole.columns or set(split.columns) == set(whole.columns)
    a, b = plan_values(whole), plan_values(split)
    assert a.keys() == b.keys()
    for key, (value, n) in a.items():
        assert n == b[key][1] == hours and value == pytest.approx(b[key][0], rel=1e-9, abs=1e-6)
    assert D.dispatch_check(split).count() == 0


def test_blocks_that_never_meet_take_the_whole_horizon(spark):
    """Equal prices: nothing tells early hours from late ones."""
    prices = price_path(spark, 60, 1, "a").withColumn("price", F.lit(5.0))
    a, b = plan_values(D.battery_dispatch(prices)), plan_values(D.long_battery_dispatch(prices, block=6))
    assert {k: pytest.approx(v) for k, v in a.items()} == b
    gaps = prices.withColumn("price", F.when(F.hour(HOUR) != 3, F.col("price")))
    rows = D.long_battery_dispatch(gaps, block=6).collect()
    assert len(rows) == 180 and {r.status for r in rows} == {"infeasible"} and all(r.soc_mwh is None for r in rows)
    assert D.long_battery_dispatch(prices.limit(0)).count() == 0


def test_five_years_in_one_horizon(spark):
    prices = price_path(spark, 5 * 8760, 9, "a")
    base = [D.Battery()]
    a, b = plan_values(D.battery_dispatch(prices, base)), plan_values(D.long_battery_dispatch(prices, base, block=2000))
    assert a["a", "base"][0] == pytest.approx(b["a", "base"][0], rel=1e-9) and b["a", "base"][1] == 5 * 8760
