"""Demand forecasts for the hours after the last known one."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwatt.functions import times as TM
from hourwatt.operators import additive
from hourwatt.operators.additive import BAND_Z, Model
from hourwatt.operators.grid import HOUR, next_hours, within_days
from hourwatt.session import task_count

cloudpickle.register_pickle_by_value(additive)  # executors need no installed copy


CHUNK = 8766  # hours of a series that one task sums: a year


def _hour_cell(ts: Column) -> Column:
    """Hours of the day, numbered below the hours of the week."""
    return F.hour(ts) - 24


def seasonal_profile_forecast(
    df: DataFrame,
    horizon: int = 48,
    profile: str = "hour_of_week",
    value: str = "demand_mw",
    keys: Sequence[str] = ("series_id",),
    least_readings: int = 2,
) -> DataFrame:
    """Mean of the same hour of the week (or day) with an 80 % band around it.

    An hour of the week seen fewer than ``least_readings`` times falls back to its hour of the day;
    ``profile_used`` says which one a row comes from.
    """
    if profile not in ("hour", "hour_of_week"):
        raise ValueError(f"unknown profile: {profile}")
    keys, ts = list(keys), F.col(HOUR)
    wanted = [_hour_cell(ts)] + ([TM.hour_of_week(ts)] if profile == "hour_of_week" else [])
    # One pass: a series becomes at most 24 + 168 cells, then one row with a map of them.
    cells = (
        df.select(*keys, HOUR, value, F.explode(F.array(*wanted)).alias("_cell"))
        .groupBy(*keys, "_cell")
        .agg(
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("sd"),
            F.count(value).alias("n"),
            F.max(HOUR).alias("_last"),
        )
    )
    entry = F.struct(F.col("_cell"), F.struct("mean", "sd", "n"))
    series = cells.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_cells"), F.max("_last").alias(HOUR)
    )
    ahead = series.select(*keys, "_cells", F.explode(next_hours(ts, horizon)).alias(HOUR))
    by_hour = F.try_element_at("_cells", _hour_cell(ts))
    by_week = F.try_element_at("_cells", TM.hour_of_week(ts))
    weekly = F.coalesce(by_week["n"] >= least_readings, F.lit(False))
    cell = F.when(weekly, by_week).otherwise(by_hour)
    used = F.when(weekly, "hour_of_week").otherwise("hour").alias("profile_used")
    found = ahead.select(*keys, HOUR, cell.alias("_cell"), used)
    mean, half = F.col("_cell.mean"), F.coalesce("_cell.sd", F.lit(0.0)) * BAND_Z
    return found.select(
        *keys,
        HOUR,
        mean.alias("yhat"),
        (mean - half).alias("yhat_lower"),
        (mean + half).alias("yhat_upper"),
        "profile_used",
    )


def _recent(
    df: DataFrame, keys: Sequence[str], as_of: datetime | None, history_days: int | None
) -> DataFrame:
    """The last ``history_days`` before ``as_of``, or else before the last hour of each series."""
    if history_days is None:
        return df
    if as_of is not None:
        return within_days(df, as_of, history_days)
    ends = df.groupBy(*keys).agg(F.max(HOUR).alias("_last"))
    first = F.col("_last") - F.make_dt_interval(F.lit(history_days))
    return df.join(ends, list(keys)).where(F.col(HOUR) >= first).drop("_last")


def normal_equations(
    df: DataFrame,
    model: Model = Model(),
    value: str = "demand_mw",
    keys: Sequence[str] = ("series_id",),
    as_of: datetime | None = None,
    history_days: int | None = 365,
) -> DataFrame:
    """One row per series: first and last hour, largest value, and sums of feature products.

    A series is summed in chunks of ``CHUNK`` hours, so its length does not matter to any task; what
    comes together for a series is one array of fixed size per chunk.
    """
    keys = list(keys)
    known = _recent(df.where(F.col(value).isNotNull()), keys, as_of, history_days)
    hours = known.groupBy(*keys, F.date_trunc("hour", HOUR).alias("_hour")).agg(
        F.avg(value).alias("_y"), F.count(F.lit(1)).cast("double").alias("_w")
    )
    hours = hours.withColumn("_h", (F.unix_timestamp("_hour") / 3600).cast("long"))
    largest = F.max(F.abs("_y"))
    ends = hours.groupBy(*keys).agg(
        F.min("_h").alias("first"),
        F.max("_h").alias("last"),
        F.when(largest > 0, largest).otherwise(1.0).alias("scale"),
    )
    rows = hours.join(ends, keys).withColumn("_chunk", F.floor(F.col("_h") / CHUNK))
    shape = ["first", "last", "scale"]
    rows = rows.select(*keys, "_chunk", "_h", "_y", "_w", *shape).repartition(
        task_count(df.sparkSession), *keys, "_chunk"
    )
    ends_schema = [rows.schema[c] for c in (*keys, *shape, "_chunk")]
    schema = T.StructType([*ends_schema, T.StructField("sums", T.ArrayType(T.DoubleType()))])

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        first, last, scale = pdf[shape].iloc[0]
        out = pdf[[*keys, *shape, "_chunk"]].head(1).copy()
        out["sums"] = [additive.sums(pdf["_h"], pdf["_y"], pdf["_w"], first, last, scale, model)]
        return out

    parts = rows.groupBy(*keys, "_chunk").applyInPandas(add_up, schema)
    chunks = F.transform(F.sort_array(F.collect_list(F.struct("_chunk", "sums"))), lambda c: c["sums"])
    total = F.aggregate(
        F.slice(chunks, 2, F.size(chunks)),
        F.element_at(chunks, 1),
        lambda a, b: F.zip_with(a, b, lambda x, y: x + y),
    )
    return parts.groupBy(*keys, *shape).agg(total.alias("sums"))


def additive_forecast(
    df: DataFrame,
    horizon: int = 48,
    model: Model = Model(),
    value: str = "demand_mw",
    keys: Sequence[str] = ("series_id",),
    as_of: datetime | None = None,
    history_days: int | None = 365,
) -> DataFrame:
    """Trend, daily, weekly and yearly terms fitted to each series, with an 80 % band.

    The history is cut to ``history_days`` before ``as_of``, or else before the last hour of each
    series; ``None`` takes all of it. A series is solved from its normal equations, once.
    """
    keys = list(keys)
    ready = normal_equations(df, model, value, keys, as_of, history_days)
    schema = T.StructType(
        [df.schema[k] for k in keys]
        + [T.StructField("_h", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("yhat", "yhat_lower", "yhat_upper")]
    )

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                out = additive.solve_and_extend(
                    r["sums"], r["first"], r["last"], r["scale"], horizon, model
                )
                for i, k in enumerate(keys):
                    out.insert(i, k, r[k])
                yield out

    return ready.mapInPandas(extend, schema).select(
        *keys,
        F.timestamp_seconds(F.col("_h") * 3600).alias(HOUR),
        "yhat",
        "yhat_lower",
        "yhat_upper",
    )


def gold_forecast_rows(forecast: DataFrame, run_id: str, created_at: Column) -> DataFrame:
    """Forecast rows of one run, as the gold table holds them."""
    return forecast.withColumns({"run_id": F.lit(run_id), "created_at": created_at})
