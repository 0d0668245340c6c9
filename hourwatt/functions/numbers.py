"""Number expressions: coercion, station codes, buckets, guarded arithmetic, seasonal terms."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
MISSING_TENTHS = 9999  # temperature and wind speed the station did not observe
MISSING_DEGREES = 999.0  # wind direction the station did not observe
GENERATION_SHARE = 0.95
COLD, MODERATE, HOT = "Cold (<10°C)", "Moderate (10-25°C)", "Hot (>25°C)"
PERIOD_HOURS = {"daily": 24.0, "weekly": 168.0, "yearly": 365.25 * 24}


def to_number(text: Column) -> Column:
    """Double, or null for anything that is not a plain number."""
    text = text.cast("string")
    value = F.when(~text.rlike("[dDfF]\\s*$"), text).try_cast("double")  # Java reads "1d" as 1.0
    return F.when(~F.isnan(value), value)


def _field(text: Column, index: int) -> Column:
    return F.get(F.split(text, ","), F.lit(index))


def _tenths(text: Column, keep_sentinels: bool) -> Column:
    code = text.try_cast("int")
    if not keep_sentinels:
        code = F.when(F.abs(code) != MISSING_TENTHS, code)
    return code / F.lit(10.0)


def station_temp(tmp: Column, keep_sentinels: bool = False) -> Column:
    """``+0200,1`` is 20.0 degrees."""
    return _tenths(_field(tmp, 0), keep_sentinels)


def station_wind_speed(wnd: Column, keep_sentinels: bool = False) -> Column:
    """``170,1,N,0021,1`` is 2.1 m/s; a code with too few parts is null."""
    return _tenths(_field(wnd, 3), keep_sentinels)


def station_wind_dir(wnd: Column, keep_sentinels: bool = False) -> Column:
    """``170,1,N,0021,1`` is 170 degrees."""
    degrees = to_number(_field(wnd, 0))
    return degrees if keep_sentinels else F.when(degrees != MISSING_DEGREES, degrees)


def null_double() -> Column:
    return F.lit(None).cast("double")


def derived_generation(demand: Column) -> Column:
    return demand * F.lit(GENERATION_SHARE)


def temp_bucket(temp: Column) -> Column:
    return (
        F.when(temp < 10, COLD).when(temp.between(10, 25), MODERATE).when(temp > 25, HOT)
    )


def strength_label(r: Column) -> Column:
    return F.when(F.abs(r) > 0.5, "Strong").when(F.abs(r) > 0.3, "Moderate").when(
        r.isNotNull(), "Weak"
    )


def clamp_zero(x: Column) -> Column:
    return F.when(x < 0, 0.0).otherwise(x)  # greatest() would turn null into zero


def shown(x: Column, digits: int) -> Column:
    """Rounded for display: halves go up as written, whatever their binary form."""
    return F.round(x.cast("decimal(28,6)"), digits).cast("double")


def z_score(x: Column, mean: Column, sd: Column) -> Column:
    return F.try_divide(F.abs(x - mean), sd)


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return share if digits is None else F.round(share, digits)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows that have both; null where one side is constant."""
    x2, y2 = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x2, y2), F.stddev_pop(x2) * F.stddev_pop(y2))


def mean_direction(degrees: Column) -> Column:
    """Circular mean in [0, 360)."""
    rad = F.radians(degrees)
    mean = F.degrees(F.atan2(F.avg(F.sin(rad)), F.avg(F.cos(rad))))
    return F.pmod(F.round(mean, 9), F.lit(360.0))  # rounded: -1e-15 would become 360


def seasonal_terms(ts: Column, seasons: tuple[str, ...] = tuple(PERIOD_HOURS)) -> list[Column]:
    """``sin_*`` and ``cos_*`` of the position in each season, one turn per period."""
    hours = F.unix_timestamp(ts) / F.lit(3600.0)
    out = []
    for season in seasons:
        angle = hours * F.lit(2 * math.pi / PERIOD_HOURS[season])
        out += [F.sin(angle).alias(f"sin_{season}"), F.cos(angle).alias(f"cos_{season}")]
    return out
