"""Continuous refresh of hourly tables from an event stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourwatt.operators.grid import HOUR
from hourwatt.plans.upkeep import refresh_silver
from hourwatt.session import pin_utc
from hourwatt.sources.store import TableStore

WATERMARK = "2 hours"


def stream_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of the same application whose streams keep their state in that many partitions.

    The number stays with a stream for its lifetime, so it is chosen and not left to a default.
    """
    session = pin_utc(spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def file_stream(
    spark: SparkSession, folder: str, schema, pattern: str | None = None, files: int = 1000
) -> DataFrame:
    """New parquet files of a folder, at most ``files`` per batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def hourly_stream(
    events: DataFrame,
    id_column: str = "event_id",
    ts: str = "ts",
    value: str = "value",
    keys: tuple[str, ...] = ("series_id",),
    watermark: str = WATERMARK,
) -> DataFrame:
    """Closed hours of each series; an event delivered twice counts once, late ones are dropped."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    once = timed.dropDuplicatesWithinWatermark([id_column])
    hours = once.groupBy(*keys, F.window(ts, "1 hour").alias("_w")).agg(
        F.sum(value).alias("demand_mw"), F.count(F.lit(1)).alias("event_count")
    )
    return hours.select(*keys, F.col("_w.start").alias(HOUR), "demand_mw", "event_count")


def write_hours(hours: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append closed hours to a parquet folder; stops when all present input is processed."""
    return (
        hours.writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_table(
    rows: DataFrame, store: TableStore, table: str, newest: str, checkpoint: str
) -> StreamingQuery:
    """Fold each micro-batch into a table, newest load per key.

    This is also how late corrections arrive: the batch rewrites the days it touches, and a batch
    that is repeated after a failure leaves the same rows.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        store.refresh(batch, table, newest)

    return (
        rows.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_tables(
    rows: DataFrame,
    store: TableStore,
    newest: str,
    checkpoint: str,
    stations: Mapping[str, str] | None = None,
    gold: Callable[[datetime, DataFrame], None] | None = None,
) -> StreamingQuery:
    """Demand rows into bronze and on to silver and gold, micro-batch by micro-batch.

    A batch rewrites the silver days that its rows reach, late rows included, and no others. ``gold`` gets
    the batch's clock (its largest ``newest``) and the changed series, for forecasts and plans of
    those series alone. Every step may be repeated, so a batch that runs again after a failure leaves the
    same tables.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        clock = batch.agg(F.max(newest)).first()[0]
        if clock is None:
            return
        store.refresh(batch, "bronze_demand", newest, noted=True)
        refresh_silver(store, stations, (lambda series: gold(clock, series)) if gold else None)

    return (
        rows.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
