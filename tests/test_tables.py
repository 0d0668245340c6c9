"""Feeds, stored tables, the nightly run and streams."""

import json
import subprocess
import sys
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hourwatt.config import EngineConfig
from hourwatt.operators import analytics as A
from hourwatt.operators import keys as K
from hourwatt.operators import serving as S
from hourwatt.operators.grid import HOUR
from hourwatt.operators.quality import Limits, QualityError, enforce, quality_gate
from hourwatt.plans import landing
from hourwatt.plans.nightly import nightly
from hourwatt.plans.registry import Replaced
from hourwatt.schemas import KEYS, SCHEMAS
from hourwatt.sources import feeds
from hourwatt.sources.sample import AS_OF, SampleTables
from hourwatt.sources.store import TableStore, conform, since
from hourwatt.streaming import refresh as ST

START = datetime(2024, 1, 1)


def test_demand_feed(spark, tmp_path):
    data = [
        {"period": "2025-09-28T16", "value": "100.5", "respondent": "ERCO", "type": "D"},
        {"period": "20250928T17Z", "value": 101, "respondent": "ERCO", "type": "D"},
        {"period": "2025-09-28T18", "value": "n/a", "respondent": "ERCO", "type": "D"},
        {"period": "2025-09-28T18", "value": "5", "respondent": "ERCO", "type": "NG"},
        {"period": "2025-09-28T19", "value": "6", "respondent": "OTHER", "type": "D"},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"response": {"data": data}}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"error": "no data"}))
    (tmp_path / "c.json").write_text(json.dumps({"response": {"data": []}}))
    got = feeds.read_demand_json(spark, str(tmp_path), "ERCO", "D").orderBy(HOUR).collect()
    assert [(r[HOUR].hour, r.demand_mw) for r in got] == [(16, 100.5), (17, 101.0), (18, None)]
    newest = feeds.read_demand_json(spark, str(tmp_path), "OTHER", "D", limit=1).collect()
    assert [r.demand_mw for r in newest] == [6.0]


def test_feed_without_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    assert feeds.read_demand_json(spark, str(tmp_path)).isEmpty()


def test_weather_feed(spark, tmp_path):
    rows = [
        {"STATION": "1", "DATE": f"2024-01-0{d}T10:53:00", "TMP": "+0200,1",
         "WND": "170,1,N,0021,1"} for d in (1, 2, 3, 4)
    ] + [{"STATION": "2", "DATE": "2024-01-02T00:00:00", "TMP": "", "WND": "170,1"}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    got = feeds.read_weather_json(
        spark, str(tmp_path), "1", date(2024, 1, 2), date(2024, 1, 3)
    ).orderBy(HOUR).collect()
    assert [tuple(r)[1:] for r in got] == [
        (datetime(2024, 1, d, 10), 20.0, 2.1, 170.0) for d in (2, 3)
    ]


def test_replace_keeps_readers_of_the_old_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace(demand(spark, [("a", START, 1.0, START)]), "bronze_demand")
    old = store["bronze_demand"]
    store.replace(demand(spark, [("a", START, 2.0, START)]), "bronze_demand")
    assert [r.demand_mw for r in old.collect()] == [1.0]
    assert [r.demand_mw for r in store["bronze_demand"].collect()] == [2.0]
    half = tmp_path / "bronze_demand" / "v000000000003"  # a run that was lost while it wrote
    half.mkdir()
    (half / "part-0.parquet").write_text("nothing")
    assert [r.demand_mw for r in store["bronze_demand"].collect()] == [2.0]
    store.replace(store["bronze_demand"], "bronze_demand")
    assert [r.demand_mw for r in store["bronze_demand"].collect()] == [2.0]
    assert len(store.versions("bronze_demand")) == 2


def test_rejected_rows_are_counted_and_gated(spark):
    rows = spark.createDataFrame([("2025-09-28T16",), ("yesterday",), (None,)], "period string")
    found = feeds.rejected_demand(rows)
    assert tuple(found.first()) == ("bronze_demand", 3, 2)
    tables = SampleTables(spark, "/root/testdata/sf0.001")
    checks = quality_gate(tables, AS_OF, landed=[found])
    failed = {r.check_name for r in checks.where("not passed").collect()}
    assert "rejected_pct" in failed and "unsolved_hours" not in failed


def test_unsolved_hours_fail_the_gate(spark):
    t = SampleTables(spark, "/root/testdata/sf0.001")
    broken = t["gold_dispatch"].withColumn("status", F.lit("infeasible"))
    checks = quality_gate(Replaced(t, gold_dispatch=broken), AS_OF)
    assert checks.where("check_name = 'unsolved_hours' and not passed").count() == 1


def test_first_non_empty_raises_other_failures(spark, tmp_path):
    def broken():
        raise RuntimeError("disk on fire")

    with pytest.raises(RuntimeError):
        feeds.first_non_empty(broken, lambda: spark.range(3))


def test_newest_run_survives_missing_and_equal_load_times(spark):
    rows = [
        ("a", START, "run-1", None, 1.0), ("a", START, "run-2", START, 2.0),
        ("a", START, "run-3", START, None), ("b", START, "run-1", None, 5.0),
    ]
    df = spark.createDataFrame(
        rows, f"series_id string, {HOUR} timestamp, run_id string, created_at timestamp, yhat double"
    )
    got = {r.series_id: (r.run_id, r.yhat) for r in A.newest_run(df).collect()}
    assert got == {"a": ("run-3", None), "b": ("run-1", 5.0)}
    assert {r.run_id for r in A.one_run(df).collect()} == {"run-3"}
    assert A.one_run(df, "run-1").count() == 2
    nothing = df.withColumn("created_at", F.lit(None).cast("timestamp"))
    assert A.newest_run(nothing).where("yhat is not null").count() == 1


def test_more_newest_rows_than_spark_cuts_by_itself(spark):
    rows = spark.range(6000).select(
        (F.col("id") % 2).cast("string").alias("series_id"), F.timestamp_seconds("id").alias(HOUR)
    )
    got = K.newest_rows(rows, 1500, ["series_id"])
    assert got.count() == 3000 and got.agg(F.min(F.unix_timestamp(HOUR))).first()[0] == 3000


def test_first_non_empty(spark):
    empty, full = spark.range(0), spark.range(3)
    missing = lambda: spark.read.parquet("/no/such/folder")
    assert feeds.first_non_empty(missing, lambda: empty, lambda: full).count() == 3
    assert feeds.first_non_empty(lambda: empty, lambda: empty).count() == 0


def test_conform(spark):
    df = spark.createDataFrame([(1, "a")], "demand_mw int, series_id string")
    got = conform(df, "bronze_demand")
    assert [f.dataType for f in got.schema] == [f.dataType for f in SCHEMAS["bronze_demand"]]
    assert got.first().demand_mw == 1.0 and got.first().loaded_at is None


def demand(spark, rows):
    return spark.createDataFrame(
        rows, f"series_id string, {HOUR} timestamp, demand_mw double, loaded_at timestamp"
    )


def test_refresh_keeps_the_newest_load_and_other_days(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store["bronze_demand"]
    assert store.read("bronze_demand", or_empty=True).isEmpty()
    night = [START + timedelta(days=i) for i in range(3)]
    day2 = START + timedelta(days=1)
    store.refresh(
        demand(spark, [("a", START, 1.0, night[1]), ("a", day2, 2.0, night[1])]),
        "bronze_demand", "loaded_at",
    )
    first_day = Path(store.path("bronze_demand")) / "event_date=2024-01-01"
    untouched = set(first_day.iterdir())
    store.refresh(demand(spark, [("a", day2, 3.0, night[2])]), "bronze_demand", "loaded_at")
    assert 1 == store.refresh(
        demand(spark, [("a", day2, 9.0, night[0])]), "bronze_demand", "loaded_at"
    )
    got = store["bronze_demand"].orderBy(HOUR).collect()
    assert [r.demand_mw for r in got] == [1.0, 3.0]
    assert untouched == set(first_day.iterdir())
    assert store.refresh(demand(spark, []), "bronze_demand", "loaded_at") == 0
    assert store["bronze_demand"].count() == 2


def test_scan_reads_only_days_in_range(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = [("a", START + timedelta(days=i), float(i), START) for i in range(10)]
    store.append(demand(spark, rows), "bronze_demand")
    df = store.scan("bronze_demand", [HOUR, "demand_mw"], START + timedelta(days=8))
    assert sorted(r.demand_mw for r in df.collect()) == [8.0, 9.0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "loaded_at" not in plan


def test_nightly_twice_gives_the_same_tables(spark, tmp_path):
    t = SampleTables(spark, "/root/testdata/sf0.001")
    config = EngineConfig(str(tmp_path / "tables"))
    paths = landing.land_demand(t, config.respondent), landing.land_weather(t, config.station)
    limits = Limits(max_missing_pct=100.0)
    checks = nightly(spark, config, AS_OF, *paths, limits)
    assert checks.where("not passed").isEmpty()
    store = TableStore(spark, config.root)

    def state():
        return {
            n: sorted(map(str, store[n].select(*KEYS[n], *[
                f.name for f in SCHEMAS[n] if f.dataType.typeName() == "double"
            ]).collect()))
            for n in SCHEMAS
        }

    def files(*names):
        return {f for n in names for f in Path(store.path(n)).rglob("*.parquet")}

    first, written = state(), files("bronze_demand", "bronze_weather")
    assert all(first.values())
    nightly(spark, config, AS_OF, *paths, limits)
    again = state()
    assert files("bronze_demand", "bronze_weather") == written  # nothing was rewritten
    assert {n: len(v) for n, v in first.items()} == {n: len(v) for n, v in again.items()}
    for n in ("bronze_demand", "bronze_weather", "silver_demand_weather"):
        assert first[n] == again[n]
    # A later night adds a run; readers take the newest one for each hour.
    later = AS_OF + timedelta(hours=1)
    nightly(spark, config, later, *paths, limits)
    assert store["gold_forecasts"].count() == 2 * len(first["gold_forecasts"])
    seen = S.forecast_horizon(store, later)
    assert seen.count() == seen.select(HOUR).distinct().count()
    assert {r.run_id for r in seen.select("run_id").distinct().collect()} == {"run-20240131T133400"}


def test_nightly_for_many_respondents_and_stations(spark, tmp_path):
    t = SampleTables(spark, "/root/testdata/sf0.001", 5)
    names = ("0", "1", "2", "3", "4")
    config = EngineConfig(str(tmp_path), respondent=names, station=("0", "1", "0", "1", "0"))
    limits = Limits(max_missing_pct=100.0)
    nightly(spark, config, AS_OF, landing.land_demand(t), landing.land_weather(t), limits)
    store = TableStore(spark, config.root)
    assert {r[0] for r in store["bronze_weather"].select("series_id").distinct().collect()} == {"0", "1"}
    for table in ("bronze_demand", "silver_demand_weather", "gold_forecasts", "gold_dispatch"):
        assert {r[0] for r in store[table].select("series_id").distinct().collect()} == set(names)
    silver = store["silver_demand_weather"].select("series_id", HOUR, "temp_c")
    shared = silver.where("series_id = '0'").join(
        silver.where("series_id = '2'").select(HOUR, F.col("temp_c").alias("other")), HOUR
    )
    weather = store["bronze_weather"].where("series_id = '0' and temp_c is not null").select(HOUR)
    seen = shared.join(weather, HOUR)
    assert seen.count() > 10 and seen.where("not temp_c <=> other").isEmpty()


def test_gate_fails_on_old_or_repeated_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = [("a", START, 1.0, START), ("a", START, 2.0, START)]
    store.append(demand(spark, rows), "bronze_demand")
    for name in set(SCHEMAS) - {"bronze_demand"}:
        store.append(store.read(name, or_empty=True), name)
    checks = quality_gate(store, START + timedelta(days=30))
    failed = {(r.check_name, r.table_name) for r in checks.where("not passed").collect()}
    assert ("duplicate_keys", "bronze_demand") in failed
    assert ("lag_hours", "bronze_demand") in failed
    assert ("row_count", "gold_forecasts") in failed
    with pytest.raises(QualityError):
        enforce(checks)


def test_empty_history_raises(spark, tmp_path):
    from hourwatt.plans.nightly import dispatch_to_gold, forecast_to_gold

    store, config = TableStore(spark, str(tmp_path)), EngineConfig(str(tmp_path))
    with pytest.raises(FileNotFoundError):
        forecast_to_gold(store, config, AS_OF)
    for name in SCHEMAS:
        store.append(store.read(name, or_empty=True), name)
    with pytest.raises(ValueError):
        forecast_to_gold(store, config, AS_OF)
    with pytest.raises(ValueError):
        dispatch_to_gold(store, config, AS_OF)


def events(spark, folder, name, rows):
    schema = "event_id bigint, ts timestamp, value double, series_id string"
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_stream_drops_repeats_and_late_events(spark, tmp_path):
    schema = "event_id bigint, ts timestamp, value double, series_id string"
    target, check = str(tmp_path / "out"), str(tmp_path / "check")
    batches = [
        [(1, START, 1.0, "a"), (1, START, 1.0, "a"), (2, START + timedelta(minutes=90), 5.0, "a")],
        [(3, START + timedelta(hours=9), 7.0, "a")],
        [(4, START + timedelta(minutes=5), 100.0, "a"), (5, START + timedelta(hours=20), 1.0, "a")],
    ]
    for batch in batches:
        events(spark, tmp_path, "in", batch)
        stream = ST.file_stream(spark, str(tmp_path / "in"), schema)
        ST.write_hours(ST.hourly_stream(stream), target, check).awaitTermination()
    got = spark.read.parquet(target).orderBy(HOUR).collect()
    assert [(r[HOUR], r.demand_mw, r.event_count) for r in got] == [
        (START, 1.0, 1),
        (START + timedelta(hours=1), 5.0, 1),
        (START + timedelta(hours=9), 7.0, 1),
    ]


def test_stream_into_table_takes_late_corrections(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    schema = f"series_id string, {HOUR} timestamp, demand_mw double, loaded_at timestamp"
    loads = [(START, 1.0), (START + timedelta(days=2), 3.0), (START + timedelta(days=1), 2.0)]
    for loaded, value in loads:
        rows = demand(spark, [("a", START, value, loaded)])
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = ST.file_stream(spark, str(tmp_path / "in"), schema)
        ST.refresh_table(
            stream, store, "bronze_demand", "loaded_at", str(tmp_path / "check")
        ).awaitTermination()
    assert [r.demand_mw for r in store["bronze_demand"].collect()] == [3.0]


def test_tasks_need_no_installed_package(tmp_path):
    """Executors that cannot import the package still run the Python steps."""
    root = Path(__file__).resolve().parent.parent
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
from __spark_entry__ import queries
from hourwatt.session import build_session
spark = build_session(master="local[2]", spark__sql__shuffle__partitions="2")
for name in ("additive_forecast", "battery_dispatch", "generation_dispatch"):
    assert queries()[name](spark, "/root/testdata/sf0.001").count()
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=300)


def test_horizon_skips_old_partitions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    t = SampleTables(spark, "/root/testdata/sf0.001")
    store.append(t["gold_forecasts"], "gold_forecasts")
    df = since(store["gold_forecasts"], F.lit(AS_OF).cast("timestamp"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert A.newest_run(df).count() == df.count()
