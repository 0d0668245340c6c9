"""Readers of landed feed files.

A feed file is one JSON document and is parsed by one task, so a landing folder holds many
files of bounded size; the demand feed serves pages of at most ``FEED_LIMIT`` rows. A file that
cannot be read as JSON (a truncated page) gives one landed row that holds its text and nothing else:
it is counted as rejected and takes no part in anything else.

Several rows for one hour: the newest page wins, and in a page the last row. Pages are as new as
their names say, so they are landed under names that rise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourwatt.functions import numbers as N
from hourwatt.functions import times as TM
from hourwatt.schemas import BROKEN, DEMAND_FEED, DEMAND_ROW, WEATHER_FEED

FEED_LIMIT = 10_000  # fixed value: rows the demand feed serves per request, newest first


LANDED_ORDER = ("page", "position")  # of the rows of a feed, oldest first


def _broken(other: str) -> Column:
    """The text of a broken file. Named beside another column, since Spark does not answer queries on
    raw JSON that need the text alone."""
    return F.coalesce(F.when(F.col(other).isNotNull(), F.col(BROKEN)), F.col(BROKEN)).alias(BROKEN)


def demand_rows_of(pages: DataFrame) -> DataFrame:
    """Rows of ``response.data`` with their page and place in it; a broken page is one row."""
    nothing = F.lit(None).cast(DEMAND_ROW)
    data = F.when(F.col(BROKEN).isNotNull(), F.array(nothing)).otherwise(F.col("response.data"))
    page = F.col("_metadata.file_path").alias("page")
    rows = pages.select(page, _broken("response"), F.posexplode(data))
    return rows.select("page", F.col("pos").alias("position"), "col.*", BROKEN)


def landed_demand(spark: SparkSession, path: str) -> DataFrame:
    return demand_rows_of(spark.read.schema(DEMAND_FEED).json(path, multiLine=True))


def readable(landed: DataFrame) -> DataFrame:
    """Landed rows without those that stand for a broken file."""
    return landed.where(F.col(BROKEN).isNull()).drop(BROKEN)


def broken_files(landed: DataFrame) -> DataFrame:
    """(page, record): the files that cannot be read, and their text."""
    return landed.where(F.col(BROKEN).isNotNull()).select("page", F.col(BROKEN).alias("record"))


def demand_feed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``response.data`` as landed: period, value, respondent, type (all text)."""
    return readable(landed_demand(spark, path)).drop(*LANDED_ORDER)


def _one_of(column: str, wanted: str | Sequence[str]) -> Column:
    return F.col(column).isin([wanted] if isinstance(wanted, str) else list(wanted))


def select_feed(
    rows: DataFrame,
    respondent: str | Sequence[str] | None,
    type: str | None,
    limit: int | None = None,
) -> DataFrame:
    """Given respondents and row type; with ``limit``, the newest rows as one request serves them."""
    if respondent is not None:
        rows = rows.where(_one_of("respondent", respondent))
    if type is not None:
        rows = rows.where(F.col("type") == type)
    if limit is not None:
        rows = rows.orderBy(F.desc("period"), F.desc("value")).limit(limit)
    return rows


def parse_demand(rows: DataFrame, series: str = "respondent") -> DataFrame:
    """(series_id, timestamp_hour, demand_mw), and the landed order where the rows have it."""
    return rows.select(
        F.coalesce(series, F.lit("")).alias("series_id"),
        TM.feed_hour(F.col("period")).alias("timestamp_hour"),
        N.to_number(F.col("value")).alias("demand_mw"),
        *[c for c in LANDED_ORDER if c in rows.columns],
    )


def rejected(rows: DataFrame, parsed: Column, name: str) -> DataFrame:
    """(table_name, rows_landed, rows_rejected): rows whose time cannot be read are rejected.

    Given landed rows, a broken file counts as one of them.
    """
    return rows.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("rows_landed"),
        F.count_if(parsed.isNull()).alias("rows_rejected"),
    )


def rejected_demand(rows: DataFrame) -> DataFrame:
    return rejected(rows, TM.feed_hour(F.col("period")), "bronze_demand")


def rejected_weather(rows: DataFrame) -> DataFrame:
    return rejected(rows, F.col("DATE").try_cast("timestamp"), "bronze_weather")


def read_demand_json(
    spark: SparkSession,
    path: str,
    respondent: str | Sequence[str] | None = None,
    type: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """(series_id, timestamp_hour, demand_mw); no rows when the feed has no data."""
    rows = select_feed(demand_feed_rows(spark, path), respondent, type, limit)
    return parse_demand(rows)


def weather_rows_of(pages: DataFrame) -> DataFrame:
    fields = [c for c in WEATHER_FEED.names if c != BROKEN]
    return pages.select(F.col("_metadata.file_path").alias("page"), *fields, _broken("STATION"))


def landed_weather(spark: SparkSession, path: str) -> DataFrame:
    return weather_rows_of(spark.read.schema(WEATHER_FEED).json(path, multiLine=True))


def weather_feed_rows(spark: SparkSession, path: str) -> DataFrame:
    return readable(landed_weather(spark, path)).drop("page")


def clean_weather(
    rows: DataFrame,
    start: date | None = None,
    end: date | None = None,
    keep_sentinels: bool = False,
    series: str = "STATION",
) -> DataFrame:
    """Hour and parsed fields of each observation from ``start`` to ``end``, both days included."""
    seen = F.col("DATE").try_cast("timestamp")
    if start is not None:
        rows = rows.where(F.to_date(seen) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.to_date(seen) <= F.lit(end))
    return rows.select(
        F.coalesce(series, F.lit("")).alias("series_id"),
        TM.observed_hour(F.col("DATE")).alias("timestamp_hour"),
        N.station_temp(F.col("TMP"), keep_sentinels).alias("temp_c"),
        N.station_wind_speed(F.col("WND"), keep_sentinels).alias("wind_speed_mps"),
        N.station_wind_dir(F.col("WND"), keep_sentinels).alias("wind_dir_deg"),
    )


def read_weather_json(
    spark: SparkSession,
    path: str,
    station: str | Sequence[str] | None = None,
    start: date | None = None,
    end: date | None = None,
    keep_sentinels: bool = False,
) -> DataFrame:
    rows = weather_feed_rows(spark, path)
    if station is not None:
        rows = rows.where(_one_of("STATION", station))
    return clean_weather(rows, start, end, keep_sentinels)


def first_non_empty(*candidates: Callable[[], DataFrame]) -> DataFrame:
    """The first source that exists and has rows; the last one is returned as it is.

    Only a path that is not there counts as absent. Any other failure is raised.
    """
    for candidate in candidates[:-1]:
        try:
            found = candidate()
            if not found.isEmpty():
                return found
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
    return candidates[-1]()
