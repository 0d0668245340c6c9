"""One row per key, newest rows, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


CUT_LIMIT, SLICES = 1000, 64


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` per key.

    An aggregate, not a ranking window: each map task keeps one row per key, so a key that holds
    a large share of the rows is reduced before the shuffle. Rows without an order count as the
    oldest ones. A single whole-number order gives each value column its own ``max_by`` (a hash
    aggregate) and should be unique within a key; otherwise whole rows are compared by all order
    columns, then by their values, so that ties always end the same way.
    """
    rest = [c for c in df.columns if c not in keys]
    if len(order) == 1 and dict(df.dtypes)[order[0]] in ("bigint", "int"):
        place = F.coalesce(F.col(order[0]).cast("long"), F.lit(-(2**63)))
        picks = [F.max_by(c, place).alias(c) for c in rest]
        return df.groupBy(*keys).agg(*picks).select(*df.columns)
    best = F.max(F.struct(F.struct(*order).alias("_order"), F.struct(*rest).alias("row"))).alias("_best")
    df_best = df.groupBy(*keys).agg(best).select(*keys, F.col("_best.row").alias("best"))
    return df_best.select(*keys, "best.*").select(*df.columns)



def newest_rows(
    df: DataFrame, n: int, by: Sequence[str] = (), order: str = "timestamp_hour"
) -> DataFrame:
    """The last ``n`` rows by time, of the whole frame or of each group.

    Both forms cut to ``n`` rows per input task before anything is shuffled. Spark does so for up to
    ``CUT_LIMIT`` rows of a group; above it, rows are first cut within ``SLICES`` parts of a group.
    """
    if not by:
        return df.orderBy(F.desc(order)).limit(n)
    if n > CUT_LIMIT:
        part = F.pmod(F.xxhash64(order), F.lit(SLICES)).alias("_part")
        within = Window.partitionBy(*by, "_part").orderBy(F.desc(order))
        df = df.select("*", part).withColumn("_rank", F.row_number().over(within))
        df = df.where(F.col("_rank") <= n).drop("_rank", "_part")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def top(df: DataFrame, order: Sequence[Column | str], limit: int | None) -> DataFrame:
    """Sorted rows; with a limit only the first ones, found without a full sort."""
    df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)
