"""Best use of a store over a horizon: what the dispatch jobs run on each Arrow batch.

The value of a store's level is concave and piecewise linear, and so is the value of releasing
energy within an hour. Going back one hour therefore merges two lists of segments by slope; going
forward reads from the merged list how much each segment contributes. Exact, without a solver.
All functions work on many scenarios at once: the first axis is the scenario.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd

BATCH = 512  # scenarios solved together, so that their segment lists stay in cache


class Stage(NamedTuple):
    """Releases from ``start`` on, by segment: length, and value per unit (one row per scenario).

    Every scenario's segments are used in the order of falling slopes; negative release is storing.
    """

    start: np.ndarray
    lengths: np.ndarray
    slopes: np.ndarray


def best_levels(stages: list[Stage], low, high, level, worth: float = 0.0):
    """Levels after each hour, amounts taken of each stage's segments, and which plans exist.

    ``worth`` is the value of a unit that is left at the end.
    """
    first, lengths, slopes = low, (high - low)[:, None], np.full((len(low), 1), worth)
    exists, plans = np.ones(len(low), dtype=bool), []
    for stage in reversed(stages):
        own = lengths.shape[1]
        lengths = np.hstack([lengths, stage.lengths])
        slopes = np.hstack([slopes, stage.slopes])
        order = np.argsort(-slopes, axis=1, kind="stable")  # equal slopes: the store keeps energy
        lengths = np.take_along_axis(lengths, order, 1)
        slopes = np.take_along_axis(slopes, order, 1)
        plans.append((first, own, order, lengths))
        # Levels that can reach the next hour, cut to the store's limits.
        first = first + stage.start
        ends = first[:, None] + np.cumsum(lengths, axis=1)
        exists &= np.minimum(ends[:, -1], high) >= np.maximum(first, low)
        kept = np.minimum(ends, high[:, None]) - np.maximum(ends - lengths, low[:, None])
        first = np.maximum(first, low)
        used = kept > 0
        left = np.argsort(~used, axis=1, kind="stable")[:, : max(1, used.sum(axis=1).max())]
        lengths = np.take_along_axis(np.where(used, kept, 0.0), left, 1)
        slopes = np.take_along_axis(np.where(used, slopes, -np.inf), left, 1)
    exists &= (level >= first - 1e-9) & (level <= first + lengths.sum(axis=1) + 1e-9)
    levels, taken = [], []
    for stage, (first, own, order, lengths) in zip(stages, reversed(plans)):
        begins = np.cumsum(lengths, axis=1) - lengths
        reach = (level - first - stage.start)[:, None] - begins
        amounts = np.empty_like(lengths)
        np.put_along_axis(amounts, order, np.clip(reach, 0.0, lengths), 1)
        level = first + amounts[:, :own].sum(axis=1)
        levels.append(level)
        taken.append(amounts[:, own:])
    return np.stack(levels, axis=1), taken, exists


def battery_hours(prices, size, power, eta_c, eta_d, level, worth: float = 0.0):
    """Charge, discharge and level after each hour with the largest trading value.

    An hour starts from full charging; its segments are charging less and discharging.
    """
    lengths = np.stack([eta_c * power, power / eta_d], axis=1)
    stages = [
        Stage(-eta_c * power, lengths, np.stack([p / eta_c, p * eta_d], axis=1)) for p in prices.T
    ]
    levels, taken, exists = best_levels(stages, np.zeros_like(size), size, level, worth)
    less, out = (np.stack([t[:, i] for t in taken], axis=1) for i in (0, 1))
    return power[:, None] - less / eta_c[:, None], out * eta_d[:, None], levels, exists


#: More and less than any price makes of a unit: what is left counts above all, or is to be got rid of.
EXTREMES = (-1e15, 1e15)


def middle_hours(prices, lead, kernel, begins, ends, size, power, eta_c, eta_d):
    """Plan of the ``kernel`` hours after the first ``lead`` ones, and whether it is that of the whole horizon.

    A better-filled store at the beginning, or energy worth more at the end, never makes a level lower. So where
    the plans from an empty and from a full store, for worthless and for priceless remains, have the same levels,
    the whole horizon's plan has them too, whatever lies before and after. ``begins`` and ``ends`` say that nothing does.
    """
    starts = [size / 2] if begins else [np.zeros_like(size), size]
    part = slice(lead, lead + kernel)
    found, same = None, np.ones(len(size), dtype=bool)
    for level in starts:
        for worth in (0.0,) if ends else EXTREMES:
            charge, out, levels, _ = battery_hours(prices, size, power, eta_c, eta_d, level, worth)
            before = np.column_stack([level, levels])[:, lead : lead + 1]
            plan = [before, charge[:, part], out[:, part], levels[:, part]]
            found = found or plan
            for a, b in zip(found, plan):
                same &= (np.abs(a - b) <= 1e-9 * np.maximum(size, 1.0)[:, None]).all(axis=1)
    return (*found[1:], same)


def solve_middles(values: pd.Series, shape: pd.DataFrame, units: list[np.ndarray]) -> pd.DataFrame:
    """``middle_hours`` for rows of hourly prices; ``shape`` has lead, kernel, begins and ends of each."""
    rows = [None] * len(values)
    shape = shape.assign(n=values.map(len).to_numpy()).reset_index(drop=True)
    for (lead, kernel, begins, ends, _), same in shape.groupby(["lead", "kernel", "begins", "ends", "n"]).groups.items():
        same = same.to_numpy()
        for part in np.array_split(same, -(-len(same) // BATCH)):
            matrix = np.stack([np.asarray(values.iloc[i], dtype=float) for i in part])
            charge, out, levels, met = middle_hours(matrix, lead, kernel, begins, ends, *[u[part] for u in units])
            for k, i in enumerate(part):
                rows[i] = (*[np.maximum(x[k], 0.0) for x in (charge, out, levels)], bool(met[k]))
    return pd.DataFrame(rows, columns=["charge_mwh", "discharge_mwh", "soc_mwh", "met"])


def supply_stage(demand, caps, costs, power, eta_c) -> Stage:
    """Generation cost saved by releasing energy, from the highest load that can be served."""
    tops = np.concatenate([[0.0], np.cumsum(caps)])
    bottoms = np.concatenate([[-np.inf], tops[:-1]])
    saved = np.concatenate([[0.0], costs])  # a load below zero costs nothing

    def spans(low, high):
        inside = np.minimum(tops, high[:, None]) - np.maximum(bottoms, low[:, None])
        return np.maximum(inside, 0.0)

    served = np.minimum(demand, tops[-1])
    highest = np.minimum(demand + power, tops[-1])
    storing = spans(demand, highest) * eta_c
    releasing = spans(demand - power, served)
    start = np.where(highest > demand, -(highest - demand) * eta_c, demand - served)
    start = np.where(demand - power > tops[-1], np.inf, start)  # cannot be served at all
    slopes = np.concatenate([saved / eta_c, saved])
    return Stage(
        start, np.hstack([storing, releasing]), np.broadcast_to(slopes, (len(demand), len(slopes)))
    )


def supply_hours(demands, caps, costs, power, eta_c, low, high, level):
    """Charge, discharge and level after each hour with the least generation cost."""
    stages = [supply_stage(x, caps, costs, power, eta_c) for x in demands.T]
    exists = np.all([np.isfinite(s.start) for s in stages], axis=0)
    stages = [s._replace(start=np.where(np.isfinite(s.start), s.start, 0.0)) for s in stages]
    ends = (np.full(len(demands), float(x)) for x in (low, high, level))
    levels, _, reached = best_levels(stages, *ends)
    begins = np.column_stack([np.full(len(demands), float(level)), levels[:, :-1]])
    release = begins - levels
    charge, discharge = np.maximum(-release, 0.0) / eta_c, np.maximum(release, 0.0)
    return charge, discharge, levels, exists & reached


def solve_rows(values: pd.Series, solve) -> pd.DataFrame:
    """Plans for rows of hourly arrays; ``solve`` gets a matrix and the row numbers.

    A row with a missing value, or without a feasible plan, has nulls for its hours.
    """
    rows = [None] * len(values)
    counts = values.map(len).to_numpy()
    for n in np.unique(counts):
        same = np.flatnonzero(counts == n)
        for part in np.array_split(same, -(-len(same) // BATCH)):
            matrix = np.stack([np.asarray(values.iloc[i], dtype=float) for i in part])
            known = np.isfinite(matrix)
            *plan, exists = solve(np.where(known, matrix, 0.0), part)
            plan = [np.maximum(x, 0.0) for x in plan]
            for k, (i, ok) in enumerate(zip(part, exists & known.all(axis=1))):
                cells = [x[k] for x in plan] if ok else [[None] * n] * 3
                rows[i] = (*cells, "optimal" if ok else "infeasible")
    return pd.DataFrame(rows, columns=["charge_mwh", "discharge_mwh", "soc_mwh", "status"])
