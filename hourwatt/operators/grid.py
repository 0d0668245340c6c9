"""Hour grids."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourwatt.functions import times as TM
from hourwatt.session import task_count

HOUR = "timestamp_hour"


def hour_grid(df: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Every hour from the first to the last one of each key, both included.

    Hours are listed month by month, after the months have been spread over the cluster: the
    bounds of all series are a small table that would otherwise be expanded by a single task.
    """
    bounds = df.groupBy(*keys).agg(
        F.date_trunc("hour", F.min(HOUR)).alias("_from"),
        F.date_trunc("hour", F.max(HOUR)).alias("_to"),
    )
    step = F.expr("INTERVAL 1 MONTH")
    months = bounds.withColumn(
        "_month",
        F.explode(F.sequence(F.date_trunc("month", "_from"), F.date_trunc("month", "_to"), step)),
    ).repartition(task_count(df.sparkSession), *keys, "_month")
    first = F.greatest("_from", "_month")
    last = F.least("_to", F.col("_month") + step - F.expr("INTERVAL 1 HOUR"))
    return months.select(
        *keys, F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias(HOUR)
    )


def future_hours(
    df: DataFrame, horizon: int = 48, keys: Sequence[str] = ("series_id",)
) -> DataFrame:
    """The ``horizon`` hours that follow the last one of each key."""
    last = df.groupBy(*keys).agg(F.max(HOUR).alias(HOUR))
    return last.select(*keys, F.explode(next_hours(F.col(HOUR), horizon)).alias(HOUR))


def next_hours(last: Column, horizon: int) -> Column:
    """Array of the hours after the one that holds ``last``."""
    hour = F.date_trunc("hour", last)
    step = F.expr("INTERVAL 1 HOUR")
    return F.sequence(hour + step, hour + F.expr(f"INTERVAL {int(horizon)} HOURS"), step)


def within_days(df: DataFrame, as_of: datetime, days: int, ts: str = HOUR) -> DataFrame:
    """Rows of the trailing ``days`` days before ``as_of``."""
    return df.where(F.col(ts) >= TM.days_before(as_of, days))
