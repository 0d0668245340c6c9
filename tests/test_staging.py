"""What a refresh puts aside before it writes a table."""

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from hourwatt.sources.store import TableStore


def test_staged_rows_are_not_a_file_per_day(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    first = datetime(2024, 1, 1)
    rows = [("a", first + timedelta(days=k), float(k)) for k in range(40)] + [("a", None, 7.0)]
    df = spark.createDataFrame(rows, "series_id string, timestamp_hour timestamp, demand_mw double")
    folder, n = store._stage(df.coalesce(2), "bronze_demand")
    assert n == 41 and not list(Path(folder).glob("event_date=*"))
    assert len(list(Path(folder).rglob("*.parquet"))) <= 2
    assert store.refresh(df, "bronze_demand") == 41
    got = store["bronze_demand"].select("demand_mw", "event_date").where(F.col("timestamp_hour").isNotNull()).collect()
    assert {(r.demand_mw, r.event_date) for r in got} == {(v, t.date()) for _, t, v in rows if t}
