"""Feed files written from the test tables, in the shapes the feeds have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourwatt.session import new_folder
from hourwatt.sources.sample import SampleTables

PAGE = 5000  # event numbers per page, so a page has at most this many rows


def land_demand(t: SampleTables, respondent: str | None = None, torn: bool = False) -> str:
    """Pages of ``{"response": {"data": [...]}}``; errors are landed as rows of another type.

    Without a respondent each series is one. ``torn`` lands each page a second time, cut off halfway.
    """
    name = F.lit(respondent) if respondent else F.col("series_id")
    rows = t.of_type("click", "error").select(
        F.floor(F.col("event_id") / PAGE).alias("page"),
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH").alias("period"),
            F.when(F.col("event_id") % 97 == 0, "n/a")
            .otherwise(F.col("value").cast("string"))
            .alias("value"),
            name.alias("respondent"),
            F.when(F.col("event_type") == "click", "D").otherwise("NG").alias("type"),
        ).alias("row"),
        "event_id",
    )
    pages = rows.groupBy("page").agg(_in_order().alias("data"))
    pages = pages.select("page", F.to_json(F.struct(F.struct("data").alias("response"))).alias("json"))
    if torn:
        half = F.expr("substring(json, 1, length(json) div 2)")
        pages = pages.unionByName(pages.withColumn("json", half))
    return _land(pages, "demand")


def _in_order() -> Column:
    """The rows of a page, oldest event first."""
    return F.transform(F.sort_array(F.collect_list(F.struct("event_id", "row"))), lambda x: x["row"])


def land_weather(t: SampleTables, station: str | None = None) -> str:
    """Pages that are arrays of observations; without a station each series is one."""
    name = F.lit(station) if station else F.col("STATION")
    rows = t.weather_raw_numbered().select(
        F.floor(F.col("event_id") / PAGE).alias("page"),
        F.struct(name.alias("STATION"), "DATE", "TMP", "WND").alias("row"),
        "event_id",
    )
    pages = rows.groupBy("page").agg(_in_order().alias("data"))
    return _land(pages.select("page", F.to_json("data").alias("json")), "weather")


def _land(pages: DataFrame, label: str) -> str:
    """A file per page, under names that rise with the page."""
    folder = new_folder(pages.sparkSession, f"landed-{label}")
    pages.orderBy("page").select("json").write.option("maxRecordsPerFile", 1).text(folder)
    return folder
