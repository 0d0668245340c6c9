"""Battery trading and generation mix, one independent problem per scenario."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourwatt.functions import numbers as N
from hourwatt.operators import storage
from hourwatt.operators.frames import numbered_rows
from hourwatt.operators.grid import HOUR
from hourwatt.session import new_folder, task_count

cloudpickle.register_pickle_by_value(storage)  # executors need no installed copy


@dataclass(frozen=True)
class Battery:
    """Storage limit (MWh), power limit (MW), efficiencies, bid penalty; starts half full."""

    scenario_id: str = "base"
    s_max: float = 100.0
    p_max: float = 50.0
    eta_c: float = 0.95
    eta_d: float = 0.95
    lam: float = 0.01


# fixed values: the batteries in use
FLEET = (
    Battery(),
    Battery("unit", 1.0, 1.0),
    Battery("large", 200.0, 25.0, 0.9, 0.9),
)


@dataclass(frozen=True)
class Generator:
    source: str
    capacity_mw: float
    cost_per_mwh: float


# fixed values, cheapest first
GENERATORS = (
    Generator("wind", 300.0, 0.03),
    Generator("solar", 500.0, 0.05),
    Generator("gas", 800.0, 0.08),
)


@dataclass(frozen=True)
class Store:
    """The store beside the generators; limits and start are levels in MWh."""

    power_mw: float = 200.0
    eta_c: float = 0.9
    low: float = 0.1
    high: float = 1.0
    start: float = 0.5


SCENARIO = ("series_id", "scenario_id")
BATTERY_COLUMNS = ("s_max", "p_max", "eta_c", "eta_d", "lam")


def optimal_bid(price: Column, lam: Column) -> Column:
    """The bid is priced apart from the battery: ``p*b - lam*b*b`` is largest at ``p/(2*lam)``."""
    return N.clamp_zero(F.try_divide(price, lam * 2))


def with_batteries(prices: DataFrame, fleet: Sequence[Battery] | DataFrame = FLEET) -> DataFrame:
    """One copy of the price rows per battery.

    A list is a short configuration that applies to every series. A table of batteries names the
    series each one trades and is joined on it.
    """
    if isinstance(fleet, DataFrame):
        return prices.join(fleet.select("series_id", "scenario_id", *BATTERY_COLUMNS), "series_id")
    units = F.array(
        *[
            F.struct(
                F.lit(b.scenario_id).alias("scenario_id"),
                *[F.lit(float(getattr(b, c))).alias(c) for c in BATTERY_COLUMNS],
            )
            for b in fleet
        ]
    )
    return prices.select("*", F.inline(units))


def horizon_rows(
    prices: DataFrame, horizon: int | None, per: Sequence[str] = ("series_id",)
) -> DataFrame:
    """The first ``horizon`` hours of each series; all of them for ``None``."""
    if horizon is None:
        return prices
    place = F.row_number().over(Window.partitionBy(*per).orderBy(HOUR))
    return prices.withColumn("_place", place).where(F.col("_place") <= horizon).drop("_place")


_PLAN = (
    "charge_mwh array<double>, discharge_mwh array<double>, soc_mwh array<double>, status string"
)


def _by_horizon(rows: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """One row per horizon: its hours in order, and their values, as arrays."""
    pairs = F.sort_array(F.collect_list(F.struct(HOUR, value))).alias("_hours")
    return rows.groupBy(*keys).agg(pairs).withColumn("_values", F.col(f"_hours.{value}"))


def _by_hour(solved: DataFrame, value: str, columns: Sequence[str]) -> DataFrame:
    """One row per hour again."""
    hours = F.arrays_zip(
        F.col(f"_hours.{HOUR}").alias(HOUR),
        F.col("_values").alias(value),
        *[F.col(f"_plan.{c}").alias(c) for c in ("charge_mwh", "discharge_mwh", "soc_mwh")],
    )
    return solved.select(*columns, F.col("_plan.status").alias("status"), F.inline(hours))


def battery_dispatch(
    prices: DataFrame,
    fleet: Sequence[Battery] | DataFrame = FLEET,
    per: Sequence[str] = (),
    horizon: int | None = None,
    totals: bool = False,
) -> DataFrame:
    """Charge and discharge per scenario and hour with the largest trading value, and the bid.

    ``prices`` has series_id, timestamp_hour and price; ``per`` adds columns that split a series
    into separate horizons, such as a delivery day; ``horizon`` keeps only the first hours of each.
    A horizon becomes one row, so that a batch handed to Python holds many scenarios. ``totals``
    adds the profit of each horizon as ``expected_profit``, summed before its hours are separated.
    """
    keys = ["series_id", *per]
    prices = horizon_rows(prices.select(*keys, HOUR, "price"), horizon, keys)
    scenarios = with_batteries(_by_horizon(prices, "price", keys), fleet)
    scenarios = scenarios.repartition(task_count(prices.sparkSession), *keys, "scenario_id")

    @F.pandas_udf(_PLAN)
    def solve(
        prices: pd.Series, s_max: pd.Series, p_max: pd.Series, eta_c: pd.Series, eta_d: pd.Series
    ) -> pd.DataFrame:
        units = [x.to_numpy() for x in (s_max, p_max, eta_c, eta_d)]

        def plan(matrix, rows):
            size, *rest = (x[rows] for x in units)
            return storage.battery_hours(matrix, size, *rest, size / 2)

        return storage.solve_rows(prices, plan)

    solved = scenarios.withColumn("_plan", solve("_values", "s_max", "p_max", "eta_c", "eta_d"))
    columns = [*keys, "scenario_id", *BATTERY_COLUMNS]
    if totals:
        hour = F.arrays_zip(
            F.col("_values").alias("p"), F.col("_plan.charge_mwh").alias("c"), F.col("_plan.discharge_mwh").alias("d")
        )
        earned = lambda x: x["p"] * (x["d"] - x["c"] + optimal_bid(x["p"], F.col("lam")))
        total = F.aggregate(hour, F.lit(0.0), lambda a, x: a + F.coalesce(earned(x), F.lit(0.0)))
        total = F.when(F.col("_plan.status") == "optimal", total)
        solved, columns = solved.withColumn("expected_profit", total), [*columns, "expected_profit"]
    hours = _by_hour(solved, "price", columns)
    return hours.withColumn("bid_mwh", optimal_bid(F.col("price"), F.col("lam")))


def long_battery_dispatch(
    prices: DataFrame,
    fleet: Sequence[Battery] | DataFrame = FLEET,
    per: Sequence[str] = (),
    block: int = 1000,
) -> DataFrame:
    """``battery_dispatch`` for horizons of any length: the same plans, solved block by block.

    A block of hours is solved together with its neighbours, from an empty and from a full store and for
    worthless and priceless remains. Where all four agree on the block, that is the whole horizon's plan.
    Blocks where they do not agree are solved again with twice as many neighbours, in the end with the
    whole horizon. A task holds a block and its neighbours.
    """
    spark, keys = prices.sparkSession, ["series_id", *per]
    rows = numbered_rows(prices.select(*keys, HOUR, "price"), keys, name="_at")
    rows = rows.withColumn("_block", F.floor(F.col("_at") / block))
    folder = new_folder(spark, "long-horizon")

    def handed(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    rows = handed(rows, "rows")
    sizes = rows.groupBy(*keys).agg(
        F.max("_block").alias("_last"), F.bool_and(F.col("price").isNotNull()).alias("_known")
    )
    known = sizes.where("_known").drop("_known")
    blocks = rows.select(*keys, "_block").distinct().join(known, keys)
    wanted = with_batteries(blocks.withColumnRenamed("_block", "_kernel"), fleet)

    @F.pandas_udf("charge_mwh array<double>, discharge_mwh array<double>, soc_mwh array<double>, met boolean")
    def solve(
        prices: pd.Series, shape: pd.DataFrame,
        s_max: pd.Series, p_max: pd.Series, eta_c: pd.Series, eta_d: pd.Series,
    ) -> pd.DataFrame:
        units = [x.to_numpy(dtype=float) for x in (s_max, p_max, eta_c, eta_d)]
        return storage.solve_middles(prices, shape, units)

    done, around, number = [], 1, 0
    names = ["scenario_id", *BATTERY_COLUMNS]
    while True:
        near = F.sequence(
            F.greatest(F.col("_kernel") - around, F.lit(0)), F.least(F.col("_kernel") + around, "_last")
        )
        # The hours that a kernel needs are the same for all batteries of a series.
        needed = wanted.select(*keys, "_kernel", "_last").distinct().withColumn("_block", F.explode(near))
        hours = needed.join(rows, [*keys, "_block"])
        inside = F.col("_block") == F.col("_kernel")
        grouped = hours.groupBy(*keys, "_kernel", "_last").agg(
            F.sort_array(F.collect_list(F.struct("_at", HOUR, "price", inside.alias("inside")))).alias("_all"),
            F.count_if(F.col("_block") < F.col("_kernel")).alias("lead"),
            F.count_if(inside).alias("kernel"),
        )
        shaped = grouped.join(wanted, [*keys, "_kernel", "_last"]).repartition(
            task_count(spark), *keys, "scenario_id", "_kernel"
        )
        shape = F.struct(
            "lead", "kernel",
            (F.col("_kernel") <= around).alias("begins"),
            (F.col("_kernel") + around >= F.col("_last")).alias("ends"),
        )
        plan = solve(F.col("_all.price"), shape, *[F.col(c) for c in ("s_max", "p_max", "eta_c", "eta_d")])
        mine = F.filter("_all", lambda x: x["inside"])
        solved = shaped.select(
            *keys, "_kernel", "_last", *names, mine.alias("_hours"), plan.alias("_plan")
        )
        solved = handed(solved, f"round-{number}")
        done.append(solved.where("_plan.met"))
        wanted = solved.where("not _plan.met").select(*keys, "_kernel", "_last", *names)
        if wanted.isEmpty():
            break
        around, number = 2 * around, number + 1
    met = done[0]
    for more in done[1:]:
        met = met.unionByName(more)
    plans = [F.col(f"_plan.{c}").alias(c) for c in ("charge_mwh", "discharge_mwh", "soc_mwh")]
    hours = F.arrays_zip(F.col(f"_hours.{HOUR}").alias(HOUR), F.col("_hours.price").alias("price"), *plans)
    found = met.select(*keys, *names, F.lit("optimal").alias("status"), F.inline(hours))
    unknown = with_batteries(rows.join(sizes.where("not _known"), keys).select(*keys, HOUR, "price"), fleet)
    nothing = {c: F.lit(None).cast("double") for c in ("charge_mwh", "discharge_mwh", "soc_mwh")}
    unknown = unknown.withColumns(nothing | {"status": F.lit("infeasible")})
    both = found.unionByName(unknown.select(*found.columns))
    return both.withColumn("bid_mwh", optimal_bid(F.col("price"), F.col("lam")))


def hour_profit() -> Column:
    return F.col("price") * (F.col("discharge_mwh") - F.col("charge_mwh") + F.col("bid_mwh"))


def dispatch_profit(df: DataFrame, per: Sequence[str] = SCENARIO) -> DataFrame:
    """Profit of each hour, and the run total that is repeated on each row of its scenario."""
    df = df.withColumn("hour_profit", hour_profit())
    totals = df.groupBy(*per).agg(F.sum("hour_profit").alias("expected_profit"))
    return df.join(totals, list(per))


def dispatch_check(
    df: DataFrame, per: Sequence[str] = SCENARIO, tolerance: float = 1e-6
) -> DataFrame:
    """Rows that break the balance of the store, its limits, the power limits or a sign.

    ``df`` is a dispatch with the battery columns; each scenario is one horizon.
    """
    run = Window.partitionBy(*per).orderBy(HOUR)
    before = F.coalesce(F.lag("soc_mwh").over(run), F.col("s_max") / 2)
    moved = F.col("eta_c") * F.col("charge_mwh") - F.col("discharge_mwh") / F.col("eta_d")
    size = F.greatest(F.lit(1.0), F.col("s_max"))
    residual = F.col("soc_mwh") - before - moved
    eps = size * tolerance
    problems = {
        "balance": F.abs(residual) > eps,
        "level": (F.col("soc_mwh") < -eps) | (F.col("soc_mwh") > F.col("s_max") + eps),
        "power": (F.col("charge_mwh") > F.col("p_max") + eps)
        | (F.col("discharge_mwh") > F.col("p_max") + eps),
        "sign": (F.col("charge_mwh") < 0) | (F.col("discharge_mwh") < 0) | (F.col("bid_mwh") < 0),
    }
    found = F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in problems.items()]))
    checked = df.withColumn("residual", residual).withColumn("violations", found)
    return checked.where((F.size("violations") > 0) | (F.col("status") != "optimal"))


# generation mix -----------------------------------------------------------------------------


def merit_order(
    df: DataFrame,
    load: str = "demand_mw",
    generators: Sequence[Generator] = GENERATORS,
) -> DataFrame:
    """Output of each generator for a net load, cheapest first, its cost, and what is unserved."""
    ranked = sorted(generators, key=lambda g: g.cost_per_mwh)
    below, cost, columns = 0.0, F.lit(0.0), {}
    for g in ranked:
        above = F.col(load) - below
        output = F.when(above > g.capacity_mw, g.capacity_mw).otherwise(N.clamp_zero(above))
        columns[f"{g.source}_mw"] = output
        cost = cost + output * g.cost_per_mwh
        below += g.capacity_mw
    columns["cost"] = cost
    columns["unserved_mw"] = N.clamp_zero(F.col(load) - below)
    return df.withColumns(columns)


def dispatch_feasibility(
    df: DataFrame,
    generators: Sequence[Generator] = GENERATORS,
    store: Store = Store(),
    per: Sequence[str] = ("series_id",),
) -> DataFrame:
    """Whether each horizon can be served by the generators and the store, and what it costs.

    The status is that of the plan itself, so it counts only energy that the store can hold. An
    impossible horizon costs infinitely much in each of its hours.
    """
    plan = generation_dispatch(df, generators, store, per)
    fits = F.col("status") == "optimal"
    return plan.select(
        *per,
        HOUR,
        "demand_mw",
        F.lit(sum(g.capacity_mw for g in generators)).alias("capacity_mw"),
        "status",
        F.when(fits, F.col("cost")).otherwise(F.lit(float("inf"))).alias("cost"),
    )


def generation_dispatch(
    demand: DataFrame,
    generators: Sequence[Generator] = GENERATORS,
    store: Store = Store(),
    per: Sequence[str] = ("series_id",),
    horizon: int | None = None,
) -> DataFrame:
    """Least-cost mix with a store, per horizon; an impossible horizon has no outputs."""
    keys = list(per)
    rows = horizon_rows(demand.select(*keys, HOUR, "demand_mw"), horizon, keys)
    ranked = sorted(generators, key=lambda g: g.cost_per_mwh)
    caps = [g.capacity_mw for g in ranked]
    costs = [g.cost_per_mwh for g in ranked]
    horizons = _by_horizon(rows, "demand_mw", keys)
    horizons = horizons.repartition(task_count(demand.sparkSession), *keys)

    setting = (store.power_mw, store.eta_c, store.low, store.high, store.start)

    @F.pandas_udf(_PLAN)
    def solve(demands: pd.Series) -> pd.DataFrame:  # captures plain numbers only
        def plan(matrix, rows):
            return storage.supply_hours(matrix, np.array(caps), np.array(costs), *setting)

        return storage.solve_rows(demands, plan)

    solved = _by_hour(horizons.withColumn("_plan", solve("_values")), "demand_mw", keys)
    net = F.col("demand_mw") + F.col("charge_mwh") - F.col("discharge_mwh")
    mixed = merit_order(solved.withColumn("net_load_mw", net), "net_load_mw", ranked)
    return mixed.drop("unserved_mw")


def generation_mix_summary(
    df: DataFrame,
    generators: Sequence[Generator] = GENERATORS,
    per: Sequence[str] = (),
) -> DataFrame:
    """Energy and cost per source."""
    sources = F.array(
        *[
            F.struct(
                F.lit(g.source).alias("source"),
                F.col(f"{g.source}_mw").alias("_mw"),
                F.lit(g.cost_per_mwh).alias("_cost"),
            )
            for g in generators
        ]
    )
    rows = df.select(*per, F.inline(sources))
    return rows.groupBy(*per, "source").agg(
        F.sum("_mw").alias("total_mwh"), F.sum(F.col("_mw") * F.col("_cost")).alias("total_cost")
    ).orderBy(*per, "source")


def store_summary(df: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Highest and lowest level of the store."""
    return df.groupBy(*per).agg(
        F.max("soc_mwh").alias("peak_soc"), F.min("soc_mwh").alias("min_soc")
    )


def gold_dispatch_rows(
    prices: DataFrame,
    run_id: str,
    created_at: Column,
    fleet: Sequence[Battery] | DataFrame = FLEET,
    horizon: int | None = None,
) -> DataFrame:
    """Dispatch, bids and profits as rows of the gold table."""
    solved = battery_dispatch(prices, fleet, horizon=horizon, totals=True)
    return solved.withColumns(
        {"hour_profit": hour_profit(), "run_id": F.lit(run_id), "created_at": created_at}
    )
