"""Fit of one series from sums over its rows: the numeric part of the additive forecast."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

BAND_Z = 1.2816  # fixed value: half width of an 80 % band in standard deviations
SPAN = 0.8  # fixed value: trend hinges lie in this first part of the history
SEASONS = {"daily": (24.0, 4), "weekly": (168.0, 3), "yearly": (8766.0, 10)}  # hours, pairs
# fixed values: prior widths of level and slope, trend hinges, seasonal terms
WIDTH_TREND, WIDTH_HINGE, WIDTH_SEASON = 5.0, 0.05, 10.0


@dataclass(frozen=True)
class Model:
    daily: bool = True
    weekly: bool = True
    yearly: bool = False
    hinges: int = 25
    shrink: bool = True


def _design(hours, first, span, model: Model):
    """Columns for level, slope, hinges and seasons, and the prior width of each."""
    t = (hours - first) / span
    columns, widths = [np.ones_like(t), t], [WIDTH_TREND, WIDTH_TREND]
    for edge in np.linspace(0, SPAN, model.hinges + 1)[1:]:
        columns.append(np.maximum(t - edge, 0.0))
        widths.append(WIDTH_HINGE)
    for season, (period, pairs) in SEASONS.items():
        if getattr(model, season):
            for k in range(1, pairs + 1):
                angle = 2 * np.pi * k * hours / period
                columns += [np.sin(angle), np.cos(angle)]
                widths += [WIDTH_SEASON] * 2
    return np.column_stack(columns), np.array(widths)


def shape_of(first: float, last: float) -> tuple[float, float]:
    """Where the trend begins and how long it is."""
    return first, max(last - first, 1.0)


def sums(hours, values, weights, first: float, last: float, scale: float, model: Model) -> np.ndarray:
    """Weighted sums of feature products of some rows: adding those of parts gives those of the whole.

    The product matrix row by row, then products with the values, the values' squares, the weight.
    """
    x, _ = _design(np.asarray(hours, float), *shape_of(first, last), model)
    y, w = np.asarray(values, float) / scale, np.asarray(weights, float)
    weighted = x * w[:, None]
    return np.concatenate([(weighted.T @ x).ravel(), weighted.T @ y, [(w * y * y).sum(), w.sum()]])


def solve_and_extend(
    total, first: float, last: float, scale: float, horizon: int, model: Model
) -> pd.DataFrame:
    """Fitted values and band for the ``horizon`` hours after the last one, from the sums alone."""
    ahead = np.arange(1, horizon + 1) + int(last)
    x, widths = _design(ahead.astype(float), *shape_of(first, last), model)
    total, p = np.asarray(total), len(widths)
    gram, right = total[: p * p].reshape(p, p), total[p * p : p * p + p]
    squares, weight = total[-2:]

    def solve(penalty):
        return np.linalg.lstsq(gram + np.diag(penalty), right, rcond=1e-12)[0]

    def spread(beta):
        rest = squares - 2 * beta @ right + beta @ gram @ beta
        return np.sqrt(max(rest, 0.0) / max(weight - p, 1.0))

    beta = solve(np.zeros(p))
    if model.shrink:  # penalties that match normal priors at the noise level just seen
        beta = solve(spread(beta) ** 2 / widths**2)
    yhat, half = x @ beta * scale, BAND_Z * spread(beta) * scale
    return pd.DataFrame(
        {"_h": ahead, "yhat": yhat, "yhat_lower": yhat - half, "yhat_upper": yhat + half}
    )
