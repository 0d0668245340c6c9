"""Exact quantiles of large groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(
    df: DataFrame,
    value: str,
    points: Mapping[str, float],
    keys: Sequence[str],
    slices: int = 4096,
    rounds: int = 2,
) -> DataFrame:
    """Interpolated quantiles per key, with minimum and maximum, without gathering a group.

    Equal values are counted first. The value range of each key is cut into equal slices, which are
    counted; a quantile's rank falls into one slice. A second round cuts that slice again, so that
    a few far outliers do not leave the bulk in one slice. Only what is left is put in order.
    """
    keys = list(keys)
    values = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    stats = values.groupBy(*keys).agg(
        F.min("_v").alias("min_value"), F.max("_v").alias("max_value"), F.sum("_c").alias("_n")
    )
    # Ranks count from 0; a quantile lies between the two ranks around p * (n - 1).
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("_name"), (F.lit(p) * (F.col("_n") - 1)).alias("_at"))
            for name, p in points.items()
        ]
    )
    ranks = stats.select(*keys, F.inline(wanted)).select(
        "*",
        F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_rank"),
        F.lit(0).cast("long").alias("_skip"),
    )
    rest, at = values, list(keys)
    for number in range(rounds):
        slice_column = f"_slice{number}"
        if number == 0:
            ends = stats.selectExpr(*at, "min_value as _lo", "max_value as _hi")
        else:
            ends = rest.groupBy(*at).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        cut = F.width_bucket("_v", F.col("_lo"), F.col("_hi"), F.lit(slices))
        cut = F.coalesce(cut, F.lit(1))  # null where both ends are equal
        sliced = rest.join(ends, at).withColumn(slice_column, cut).drop("_lo", "_hi")
        below = Window.partitionBy(*at).orderBy(slice_column).rowsBetween(
            Window.unboundedPreceding, -1
        )
        counts = sliced.groupBy(*at, slice_column).agg(F.sum("_c").alias("_m"))
        counts = counts.withColumn("_before", F.coalesce(F.sum("_m").over(below), F.lit(0)))
        first = F.col("_skip") + F.col("_before")
        ranks = (
            ranks.join(counts, at)
            .where((F.col("_rank") >= first) & (F.col("_rank") < first + F.col("_m")))
            .withColumn("_skip", first)
            .drop("_before", "_m")
        )
        at = [*at, slice_column]
        rest = sliced.join(ranks.select(*at).distinct(), at, "left_semi")
    order = Window.partitionBy(*at).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upto = F.col("_skip") + F.col("_upto")
    found = (
        rest.withColumn("_upto", F.sum("_c").over(order))
        .join(ranks, at)
        .where((F.col("_rank") < upto) & (F.col("_rank") >= upto - F.col("_c")))
    )
    share = F.col("_at") - F.floor("_at")
    weight = F.when(F.col("_rank") == F.floor("_at"), 1 - share).otherwise(share)
    out = found.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("_name") == name, F.col("_v") * weight)).alias(name)
            for name in points
        ]
    )
    return out.join(stats.select(*keys, "min_value", "max_value"), keys)
