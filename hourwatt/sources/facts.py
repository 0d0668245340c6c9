"""What a table's days hold in numbers: rows, repeated keys, newest hour, sums of the measured value.

Facts of days add up to facts of the table, so checks that read them read days and not rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwatt.schemas import KEYS

#: The value whose gaps and extremes are watched.
MEASURED = {
    "bronze_demand": "demand_mw",
    "bronze_weather": "temp_c",
    "silver_demand_weather": "demand_mw",
    "gold_forecasts": "yhat",
    "gold_dispatch": "price",
}
FACTS = (
    "event_date date, run_id string, created_at timestamp, row_count long, duplicate_keys long,"
    " latest_data timestamp, known long, total double, squares double, low double, high double,"
    " unsolved long"
)


def day_facts(df: DataFrame, table: str, keys: list[str] | None = None) -> DataFrame:
    """A row of facts per day, and per run where the table has runs."""
    keys = list(keys or KEYS[table])
    have, hour = df.columns, "timestamp_hour"
    run = F.col("run_id") if "run_id" in have else F.lit(None).cast("string")
    created = F.max("created_at") if "created_at" in have else F.lit(None).cast("timestamp")
    unsolved = F.count_if(~F.col("status").eqNullSafe("optimal")) if "status" in have else F.lit(0)
    value = F.col(MEASURED[table]).cast("double")
    rows = df.withColumns({"_day": F.to_date(hour), "_run": run, "_value": value})
    # First by key, where repeated keys show; then by day.
    copies = rows.groupBy("_day", "_run", *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(hour).alias("hour"),
        F.count("_value").alias("known"),
        F.sum("_value").alias("total"),
        F.sum(F.col("_value") * F.col("_value")).alias("squares"),
        F.min("_value").alias("low"),
        F.max("_value").alias("high"),
        created.alias("created"),
        unsolved.cast("long").alias("unsolved"),
    )
    return copies.groupBy(F.col("_day").alias("event_date"), F.col("_run").alias("run_id")).agg(
        F.max("created").alias("created_at"),
        F.sum("n").alias("row_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.max("hour").alias("latest_data"),
        *[F.sum(c).alias(c) for c in ("known", "total", "squares")],
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("unsolved").alias("unsolved"),
    )
