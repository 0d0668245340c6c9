"""Silver by pieces: what a month of one series needs from the months before it.

A piece is one month of one series. Its state is small: the demand hours it holds, the hours of the grid
it covers, the last value known in it, whether it opens without a value, and the value carried into it.
With the state of all pieces at hand, a change in one month says exactly which other months it reaches: those
whose grid hours change, and those that open without a value and now get another one carried in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourwatt.operators.frames import carried_forward
from hourwatt.operators.grid import HOUR
from hourwatt.operators.silver import DEMAND, FILLED, KEY, WEATHER, weather_hourly
from hourwatt.session import task_count

PIECE = "piece"
PIECE_KEY = ["series_id", PIECE]
_VALUES = ", ".join(f"{c}: double" for c in FILLED)
_FLAGS = ", ".join(f"{c}: boolean" for c in FILLED)
STATE = (
    "series_id string, demand_first timestamp, demand_last timestamp, from_hour timestamp,"
    f" to_hour timestamp, known struct<{_VALUES}>, opens struct<{_FLAGS}>, carried struct<{_VALUES}>,"
    f" {PIECE} date"
)
STATE_COLUMNS = [
    "series_id", "demand_first", "demand_last", "from_hour", "to_hour", "known", "opens", "carried",
    PIECE,
]


def month_of(column: str = HOUR) -> Column:
    return F.trunc(column, "month")


def demand_bounds(demand: DataFrame) -> DataFrame:
    """First and last demand hour of each piece that has any."""
    return demand.groupBy("series_id", month_of().alias(PIECE)).agg(
        F.date_trunc("hour", F.min(HOUR)).alias("demand_first"),
        F.date_trunc("hour", F.max(HOUR)).alias("demand_last"),
    )


def grid_pieces(bounds: DataFrame) -> DataFrame:
    """All pieces from the first to the last demand hour of each series, and the hours they cover."""
    ends = bounds.groupBy("series_id").agg(
        F.min("demand_first").alias("_first"), F.max("demand_last").alias("_last")
    )
    months = ends.withColumn(
        PIECE,
        F.explode(F.sequence(month_of("_first"), month_of("_last"), F.expr("INTERVAL 1 MONTH"))),
    )
    begin = F.col(PIECE).cast("timestamp")
    end = F.add_months(PIECE, 1).cast("timestamp") - F.expr("INTERVAL 1 HOUR")
    return months.join(bounds, PIECE_KEY, "left").select(
        *PIECE_KEY,
        "demand_first",
        "demand_last",
        F.greatest("_first", begin).alias("from_hour"),
        F.least("_last", end).alias("to_hour"),
    )


def piece_rows(pieces: DataFrame, demand: DataFrame, weather: DataFrame) -> DataFrame:
    """Every hour of the pieces with demand and weather beside it, gaps as they are."""
    spread = pieces.repartition(task_count(pieces.sparkSession), *PIECE_KEY)
    hours = F.sequence("from_hour", "to_hour", F.expr("INTERVAL 1 HOUR"))
    grid = spread.select(*PIECE_KEY, F.explode(hours).alias(HOUR))
    return grid.join(demand.select(*KEY, *DEMAND), KEY, "left").join(
        weather_hourly(weather), KEY, "left"
    )


def piece_facts(rows: DataFrame) -> DataFrame:
    """``known``: the last value in each piece; ``opens``: whether its first hour has none."""
    first = F.min(HOUR)
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(HOUR))).alias(c) for c in FILLED]
    opens = [
        (~F.min(F.when(F.col(c).isNotNull(), F.col(HOUR))).eqNullSafe(first)).alias(c) for c in FILLED
    ]
    return rows.groupBy(*PIECE_KEY).agg(
        F.struct(*known).alias("known"), F.struct(*opens).alias("opens")
    )


def with_carried(state: DataFrame) -> DataFrame:
    """``carried``: the last value known before each piece. A window runs over the months of a series."""
    earlier = Window.partitionBy("series_id").orderBy(PIECE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = [F.last(f"known.{c}", ignorenulls=True).over(earlier).alias(c) for c in FILLED]
    return state.withColumn("carried", F.struct(*before))


def reached(before: str = "_carried") -> Column:
    """The piece opens without some value, and another one than before is carried in."""
    cells = [F.col(f"opens.{c}") & ~F.col(f"carried.{c}").eqNullSafe(F.col(f"{before}.{c}")) for c in FILLED]
    found = cells[0]
    for cell in cells[1:]:
        found = found | cell
    return found


def filled_rows(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Silver rows of the pieces: gaps take the last value of the piece, or the one carried into it."""
    inside = carried_forward(rows, FILLED, PIECE_KEY)
    joined = inside.join(pieces.select(*PIECE_KEY, "carried"), PIECE_KEY)
    cells = [
        F.coalesce(c, f"carried.{c}").alias(c) if c in FILLED else F.col(c)
        for c in (*KEY, *DEMAND, *WEATHER)
    ]
    return joined.select(*cells)
