"""Silver kept up to date: only pieces that a change reaches are built anew.

``TableStore.refresh(..., noted=True)`` notes which series and days of bronze change. ``refresh_silver`` takes the
notes to pieces (months of a series), finds the further pieces that the change reaches from the stored
state of all pieces, and rewrites the silver days that come out different. Notes go last, so a run that was lost anywhere is
repeated by the next one and ends with the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwatt.operators import pieces as P
from hourwatt.operators.grid import HOUR
from hourwatt.operators.pieces import PIECE, PIECE_KEY
from hourwatt.session import new_folder
from hourwatt.sources.store import DAY, TableStore

SILVER = "silver_demand_weather"


def state_folder(store: TableStore) -> str:
    return f"{store.root}/_silver_pieces"


def read_state(store: TableStore) -> DataFrame:
    spark, folder = store.spark, state_folder(store)
    if not store.has(folder):
        return spark.createDataFrame([], P.STATE)
    return spark.read.schema(P.STATE).parquet(folder)


def series_weather(store: TableStore, stations: Mapping[str, str] | None) -> DataFrame:
    """Weather under the name of each series; without stations it is stored so already."""
    weather = store.read("bronze_weather", or_empty=True)
    if stations is None:
        return weather
    return weather.withColumnRenamed("series_id", "station").join(pairs(store, stations), "station")


def pairs(store: TableStore, stations: Mapping[str, str]) -> DataFrame:
    """(series_id, station): as many rows as the configuration names, which Spark broadcasts."""
    return store.spark.createDataFrame(list(stations.items()), "series_id string, station string")


def _months(df: DataFrame) -> list:
    """The months in ``df``: as many as the history has."""
    return [r[0] for r in df.select(PIECE).distinct().collect()]


def _in_months(df: DataFrame, months: list) -> DataFrame:
    return df.where(F.trunc(DAY, "month").isin(months))


def noted_pieces(store: TableStore, stations: Mapping[str, str] | None) -> tuple[DataFrame, list[str]]:
    """(series_id, piece) with changed demand or weather, and the notes that say so."""
    demand, of_demand = store.changes("bronze_demand")
    weather, of_weather = store.changes("bronze_weather")
    if stations is not None:
        weather = weather.withColumnRenamed("series_id", "station")
        weather = weather.join(pairs(store, stations), "station").select("series_id", DAY)
    both = demand.unionByName(weather).select("series_id", F.trunc(DAY, "month").alias(PIECE))
    return both.distinct(), of_demand + of_weather


def refresh_silver(
    store: TableStore,
    stations: Mapping[str, str] | None = None,
    then: Callable[[DataFrame], None] | None = None,
    whole: bool = False,
) -> int:
    """Bring silver up to bronze; returns how many silver rows were built.

    ``then`` gets the changed series (``series_id``) before the notes go, for tables that depend on silver.
    Without a silver table, or with ``whole``, everything is built.
    """
    spark = store.spark
    demand, weather = store["bronze_demand"], series_weather(store, stations)
    touched, notes = noted_pieces(store, stations)
    whole = whole or not (store.exists(SILVER) and store.has(state_folder(store)))
    if whole:
        touched = demand.select("series_id", P.month_of().alias(PIECE)).distinct()
    elif not notes:
        return 0
    work = new_folder(spark, "silver")

    def handed(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    # Pieces of the touched series as they should be, beside what is stored of them.
    touched = handed(touched, "touched")
    series = touched.select("series_id").distinct()
    stored = read_state(store)
    if whole:
        stored = stored.limit(0)
    stored = stored.join(series, "series_id", "left_semi")
    fresh = demand if whole else _in_months(demand, _months(touched))
    fresh = P.demand_bounds(fresh).join(touched, PIECE_KEY, "left_semi")
    kept = stored.where(F.col("demand_first").isNotNull()).join(touched, PIECE_KEY, "left_anti")
    bounds = kept.select(*PIECE_KEY, "demand_first", "demand_last").unionByName(
        fresh.select(*PIECE_KEY, "demand_first", "demand_last")
    )
    old = stored.select(
        *PIECE_KEY, *[F.col(c).alias(f"_{c}") for c in P.STATE_COLUMNS if c not in PIECE_KEY]
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("from_hour", "to_hour")]
    now = (
        P.grid_pieces(bounds)
        .join(touched.withColumn("_touched", F.lit(True)), PIECE_KEY, "left")
        .join(old, PIECE_KEY, "left")
        .withColumn("_anew", F.coalesce("_touched", F.lit(False)) | ~(same[0] & same[1]))
    )
    now = handed(now, "now")
    anew = now.where("_anew").select(*PIECE_KEY, "from_hour", "to_hour")

    def raw(pieces: DataFrame) -> DataFrame:
        months = [] if whole else _months(pieces)
        parts = (demand, weather) if whole else (_in_months(x, months) for x in (demand, weather))
        return P.piece_rows(pieces, *parts)

    state = now.join(P.piece_facts(raw(anew)), PIECE_KEY, "left").withColumns(
        {c: F.when(F.col("_anew"), F.col(c)).otherwise(F.col(f"_{c}")) for c in ("known", "opens")}
    )
    state = handed(P.with_carried(state).withColumn("_fill", F.col("_anew") | P.reached()), "state")
    fill = state.where("_fill").select(*PIECE_KEY, "from_hour", "to_hour", "carried")
    rows = P.filled_rows(raw(fill.drop("carried")), fill)
    built = store.replace(rows, SILVER) if whole else store.refresh(rows, SILVER)

    differs = F.lit(False)
    for c in P.STATE_COLUMNS:
        if c not in PIECE_KEY:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    _store_state(store, state.where(differs).select(*P.STATE_COLUMNS), whole)
    if then is not None:
        then(series)
    store.drop(*notes, work)
    return built


def _store_state(store: TableStore, changed: DataFrame, whole: bool) -> None:
    """Changed pieces into the state table; only their months are rewritten."""
    folder, write = state_folder(store), changed
    if not whole:
        months = _months(changed)
        if not months:
            return
        rest = read_state(store).where(F.col(PIECE).isin(months))
        write = rest.join(changed, PIECE_KEY, "left_anti").select(*P.STATE_COLUMNS).unionByName(changed)
    write = write.hint("rebalance", F.col(PIECE))
    mode = write.write.mode("overwrite").partitionBy(PIECE)
    if not whole:
        mode = mode.option("partitionOverwriteMode", "dynamic")
    mode.parquet(folder)
