"""Ordered-frame operators that never put a whole series into one task.

A window partitioned by series alone is as slow as its longest series. Both operators cut a series
into pieces, run the window inside each piece, and bring over what a piece needs from the rows
before it: one carried value per column (forward fill) or a fixed number of rows (moving means).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourwatt.operators.grid import HOUR

_PIECE, _POS, _BEFORE, _INDEX, _HOME, _RUN = (
    "_piece", "_pos", "_before", "_index", "_home", "_run",
)


def carried_forward(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: str = HOUR
) -> DataFrame:
    """Nulls take the last earlier value of the same keys, which have to bound the rows of a task."""
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return df.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("series_id",),
    order: str = HOUR,
    piece: str = "month",
) -> DataFrame:
    """Replace nulls by the last earlier value of the same key; leading nulls stay.

    Expects one row per key and hour, so a piece has at most the hours of one month.
    """
    df = df.withColumn(_PIECE, F.date_trunc(piece, order))
    filled = carried_forward(df, columns, [*keys, _PIECE], order)

    # The last row of each piece holds its last known values; one row per key and month. Whole
    # rows are taken, so that this branch needs the same columns and shares the shuffle above.
    ends = filled.groupBy(*keys, _PIECE).agg(
        F.max_by(F.struct(*filled.columns), order).alias("_end")
    )
    earlier = Window.partitionBy(*keys).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        *keys,
        _PIECE,
        *[
            F.last(f"_end.{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}")
            for c in columns
        ],
    )
    joined = filled.join(carry, [*keys, _PIECE], "left")
    return joined.select(
        *[
            F.coalesce(c, f"_carry_{c}").alias(c) if c in columns else F.col(c)
            for c in df.columns
            if c != _PIECE
        ]
    )


def numbered_rows(
    df: DataFrame, keys: Sequence[str], order: str = HOUR, piece: str = "month", name: str = _INDEX
) -> DataFrame:
    """``df`` with the place of each row in its key's order, from 0 on; no window runs over a whole key."""
    columns = df.columns
    df = df.withColumn(_PIECE, F.date_trunc(piece, order))
    counts = df.groupBy(*keys, _PIECE).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        *keys, _PIECE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_BEFORE)
    )
    inside = Window.partitionBy(*keys, _PIECE).orderBy(order)
    placed = df.withColumn(_POS, F.row_number().over(inside) - 1).join(before, [*keys, _PIECE])
    return placed.select(*columns, (F.col(_BEFORE) + F.col(_POS)).alias(name))


def moving_means(
    df: DataFrame,
    value: str,
    frames: Mapping[str, tuple[int, int]],
    keys: Sequence[str] = ("series_id",),
    order: str = HOUR,
    piece: str = "month",
    rows_per_run: int = 8192,
) -> DataFrame:
    """Means over ROWS frames: ``{new column: (first offset, last offset)}``, ends included.

    Each row gets its position in its key's order: its place within a month plus the rows of the
    months before. Runs of positions are the window partitions; a row near an edge is also copied
    to the neighbour whose frames reach it. Within a run a frame is the difference of two running
    sums, so its length does not matter; the sums are taken around the run's mean, which keeps them
    small. Expects ``order`` to be unique within a key.
    """
    reach_back = max(0, 1 - min(lo for lo, _ in frames.values()))
    reach_on = max(0, max(hi for _, hi in frames.values()))
    size = max(rows_per_run, reach_back + reach_on + 1)
    kept = df.columns
    numbered = numbered_rows(df, keys, order, piece).withColumn(_HOME, F.floor(F.col(_INDEX) / size))
    place = F.col(_INDEX) % size
    copies = F.array_compact(
        F.array(
            F.col(_HOME),
            F.when(place >= size - reach_back, F.col(_HOME) + 1),
            F.when((place < reach_on) & (F.col(_HOME) > 0), F.col(_HOME) - 1),
        )
    )
    spread = numbered.withColumn(_RUN, F.explode(copies))

    run = Window.partitionBy(*keys, _RUN).orderBy(_INDEX)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = spread.withColumn("_mean", F.avg(value).over(whole))
    offset = F.col(value) - F.col("_mean")
    out = out.withColumns(
        {
            "_sum": F.coalesce(F.sum(offset).over(upto), F.lit(0.0)),
            "_count": F.count(value).over(upto),
        }
    ).withColumns(
        {"_sum_end": F.last("_sum").over(whole), "_count_end": F.last("_count").over(whole)}
    )

    def at(column: str, rows: int) -> Column:
        """The running value some rows away: nothing before the first row, all after the last."""
        if rows > 0:
            return F.coalesce(F.lead(column, rows).over(run), f"{column}_end")
        return F.coalesce(F.lag(column, -rows).over(run), F.lit(0)) if rows else F.col(column)

    def mean(lo: int, hi: int) -> Column:
        total, n = (at(c, hi) - at(c, lo - 1) for c in ("_sum", "_count"))
        return F.col("_mean") + F.try_divide(total, n)

    out = out.withColumns({name: mean(lo, hi) for name, (lo, hi) in frames.items()})
    return out.where(F.col(_RUN) == F.col(_HOME)).select(*kept, *frames)
