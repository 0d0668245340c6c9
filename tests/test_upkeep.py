"""Silver kept up to date piece by piece, landed files read once, reports of one battery."""

import json
import random
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hourwatt.config import EngineConfig
from hourwatt.operators import analytics as A
from hourwatt.operators import serving as S
from hourwatt.operators.grid import HOUR
from hourwatt.operators.silver import silver_build
from hourwatt.plans import nightly as N
from hourwatt.plans.registry import MID_MONTH, Replaced
from hourwatt.plans.upkeep import SILVER, refresh_silver
from hourwatt.sources import feeds
from hourwatt.sources.sample import SampleTables
from hourwatt.sources.store import TableStore
from hourwatt.streaming import ledger
from hourwatt.streaming import refresh as ST

START = datetime(2024, 1, 1)
DEMAND = f"series_id string, {HOUR} timestamp, demand_mw double, loaded_at timestamp"
WEATHER = f"series_id string, {HOUR} timestamp, temp_c double, wind_speed_mps double, wind_dir_deg double"


def load(store, rows, number):
    """(series, hours after START, value) at load ``number``."""
    loaded = START + timedelta(days=number)
    rows = [(s, START + timedelta(hours=h), v, loaded) for s, h, v in rows]
    df = store.spark.createDataFrame(rows, DEMAND)
    store.refresh(df, "bronze_demand", "loaded_at", noted=True)


def see(store, rows):
    rows = [(s, START + timedelta(hours=h), t, None, 10.0) for s, h, t in rows]
    store.refresh(store.spark.createDataFrame(rows, WEATHER), "bronze_weather", noted=True)


def silver_rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def rebuilt(store):
    return silver_build(store["bronze_demand"], store.read("bronze_weather", or_empty=True))


def silver_files(store):
    return {str(f): f.stat().st_mtime_ns for f in Path(store.path(SILVER)).rglob("*.parquet")}


def check(store):
    assert silver_rows(store[SILVER].drop("event_date")) == silver_rows(rebuilt(store))


DAY = 24


def test_changes_reach_exactly_what_they_should(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    month = 31 * DAY
    load(store, [("a", 0, 1.0), ("a", 5, None), ("a", 3 * month, 2.0), ("b", 10, 7.0)], 1)
    see(store, [("a", 2, 20.0), ("b", 50, 9.0)])
    refresh_silver(store)
    check(store)
    files = silver_files(store)
    assert refresh_silver(store) == 0 and silver_files(store) == files
    load(store, [("a", 0, 1.0)], 2)  # nothing new but the load time
    assert refresh_silver(store) == 0 and silver_files(store) == files

    # A late value of the first month is carried on until the next known one, two months later.
    load(store, [("a", 100, 5.0)], 3)
    refresh_silver(store)
    check(store)
    changed = {f for f, t in silver_files(store).items() if files.get(f) != t}
    days = {f.split("event_date=")[1][:10] for f in changed}
    assert min(days) == "2024-01-05" and max(days) == "2024-04-02" and len(days) > 80

    # A correction with a known value right after it changes one day.
    load(store, [("b", 11, 8.0), ("b", 12, 9.0)], 4)
    refresh_silver(store)
    files = silver_files(store)
    load(store, [("b", 11, 8.5)], 5)
    refresh_silver(store)
    check(store)
    changed = {f for f, t in silver_files(store).items() if files.get(f) != t}
    assert {f.split("event_date=")[1][:10] for f in changed} == {"2024-01-01"}

    # The grid grows at both ends, and weather seen before counts where it reaches it.
    see(store, [("b", 4 * month, 1.0), ("c", 0, 3.0), ("b", -3, 4.0)])
    refresh_silver(store)
    check(store)
    load(store, [("b", 4 * month + 5, 3.0), ("b", -40, 2.0), ("c", 2 * month, None)], 6)
    refresh_silver(store)
    check(store)


def test_random_changes_equal_a_full_build(spark, tmp_path):
    rng = random.Random(11)
    store = TableStore(spark, str(tmp_path))
    for number in range(1, 6):
        hours = [(rng.choice("ab"), rng.randrange(-900, 2500)) for _ in range(rng.choice([1, 3, 12]))]
        load(store, [(s, h, rng.choice([None, float(rng.randrange(50))])) for s, h in dict.fromkeys(hours)], number)
        if number % 2 == 0:
            see(store, [(s, h, rng.choice([None, 5.0 + number])) for s, h in dict.fromkeys(hours[::2] + [("a", 7)])])
        refresh_silver(store)
        check(store)


def test_a_run_lost_before_its_notes_went_is_repeated(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    load(store, [("a", 0, 1.0), ("a", 2000, 2.0)], 1)
    refresh_silver(store)
    load(store, [("a", 100, 9.0)], 2)
    with pytest.raises(RuntimeError):
        with monkeypatch.context() as m:
            def lost(*_):
                raise RuntimeError("driver lost")

            m.setattr("hourwatt.plans.upkeep._store_state", lost)
            refresh_silver(store)
    load(store, [("a", 100, 9.0)], 2)  # the same feed again notes nothing
    refresh_silver(store)
    check(store)
    load(store, [("a", 1900, 5.0)], 3)
    refresh_silver(store)
    check(store)


def test_stream_keeps_silver_and_gold(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    config = EngineConfig(store.root, respondent=("a", "b"))
    seen = []

    def gold(clock, series):
        seen.append((clock, {r.series_id for r in series.collect()}))
        N.forecast_to_gold(store, config, clock, series=series)
        N.dispatch_to_gold(store, config, clock, series=series)

    batches = [
        [("a", h, 50.0 + h % 24) for h in range(72)] + [("b", h, 5.0) for h in range(48)],
        [("b", 48, 6.0)],
        [("a", 10, 99.0), ("a", 72, 70.0)],
    ]
    for number, rows in enumerate(batches):
        clock = START + timedelta(hours=72 + number)
        rows = [(s, START + timedelta(hours=h), v, clock) for s, h, v in rows]
        spark.createDataFrame(rows, DEMAND).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = ST.file_stream(spark, str(tmp_path / "in"), DEMAND)
        ST.refresh_tables(
            stream, store, "loaded_at", str(tmp_path / "check"), gold=gold
        ).awaitTermination()
        check(store)
    assert [names for _, names in seen] == [{"a", "b"}, {"b"}, {"a"}]
    runs = {(r.series_id, r.run_id) for r in store["gold_forecasts"].select("series_id", "run_id").distinct().collect()}
    assert len(runs) == 4  # each run forecasts its changed series only
    last = store["gold_dispatch"].where("scenario_id = 'base' and status = 'optimal'")
    assert last.groupBy("series_id").count().count() == 2


def page(rows, kind="D"):
    return {"response": {"data": [{"period": p, "value": v, "respondent": "a", "type": kind} for p, v in rows]}}


def test_newest_page_wins_and_torn_pages_are_rejects(spark, tmp_path):
    land, store = tmp_path / "land", TableStore(spark, str(tmp_path / "tables"))
    land.mkdir()
    (land / "p1.json").write_text(json.dumps(page([("2024-01-01T00", "5000"), ("2024-01-01T01", "1")])))
    (land / "p2.json").write_text(json.dumps(page([("2024-01-01T00", "4000"), ("2024-01-01T00", "4100")])))
    (land / "p3.json").write_text(json.dumps(page([("2024-01-01T02", "7")]))[:60])
    landed = feeds.landed_demand(spark, str(land))
    assert tuple(feeds.rejected_demand(landed).first()) == ("bronze_demand", 5, 1)
    assert [Path(r.page).name for r in feeds.broken_files(landed).collect()] == ["p3.json"]
    assert feeds.read_demand_json(spark, str(land), "a", "D").count() == 4

    config, as_of = EngineConfig(store.root, respondent="a", ledger=True), datetime(2024, 1, 2)
    took = lambda rows: N.load_demand(store, config, as_of, rows)
    counts = ledger.ingest(store, "demand", str(land), took)
    assert tuple(counts.first()) == ("bronze_demand", 5, 1)
    got = {r[HOUR].hour: r.demand_mw for r in store["bronze_demand"].collect()}
    assert got == {0: 4100.0, 1: 1.0}
    assert [(Path(r.page).name, len(r.record)) for r in ledger.rejects(store, "demand").collect()] == [("p3.json", 60)]

    assert ledger.ingest(store, "demand", str(land), took).count() == 0  # every file is read once
    (land / "p4.json").write_text(json.dumps(page([("2024-01-01T01", "2")])))
    assert tuple(ledger.ingest(store, "demand", str(land), took).first()) == ("bronze_demand", 1, 0)
    assert {r[HOUR].hour: r.demand_mw for r in store["bronze_demand"].collect()} == {0: 4100.0, 1: 2.0}
    assert ledger.rejects(store, "demand").count() == 1 and ledger.rejects(store, "weather").isEmpty()

    (land / "w.json").write_text(json.dumps([{"STATION": "1", "DATE": "2024-01-01T00:00:00"}])[:30])
    seen = feeds.landed_weather(spark, str(land / "w.json"))
    assert tuple(feeds.rejected_weather(seen).first())[1:] == (1, 1)
    assert feeds.weather_feed_rows(spark, str(land / "w.json")).isEmpty()


def test_reports_speak_of_one_battery(spark):
    t = SampleTables(spark, "/root/testdata/sf0.001")
    fleet = Replaced(t, gold_dispatch=t.dispatch_fleet())
    same = [
        lambda x: A.dispatch_daily(x), lambda x: A.dispatch_by_hour(x), lambda x: A.profit_summary(x),
        lambda x: A.dispatch_summary(x), lambda x: S.dispatch_cards(x, MID_MONTH),
        lambda x: S.dispatch_horizon_view(x, MID_MONTH), lambda x: S.dispatch_chart(x, MID_MONTH),
    ]
    for report in same:
        assert silver_rows(report(t)) == silver_rows(report(fleet))
    each = A.dispatch_summary(fleet, by=["scenario_id"], battery=None)
    assert {r.scenario_id for r in each.collect()} == {"base", "unit", "large"}
    cards = S.dispatch_cards(fleet, MID_MONTH, battery="large").first()
    assert cards.total_profit == pytest.approx(2 * S.dispatch_cards(t, MID_MONTH).first().total_profit)


def test_base_queries_stand_without_the_training_data_libraries():
    root = Path(__file__).resolve().parent.parent
    code = f"""
import sys
sys.modules["zstandard"] = None
sys.path.insert(0, {str(root)!r})
from __spark_entry__ import oracle_sql, queries
from hourwatt.plans.registry import REGISTRY
assert set(queries()) == set(REGISTRY) and set(oracle_sql()) <= set(REGISTRY)
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def scanned_days(df):
    """Day partitions that the plan's scans read."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    return {Path(f).parent.name for f in df.inputFiles()}


def test_newest_day_reports_read_newest_days(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    hours = [(s, START + timedelta(hours=h), 10.0 + h % 24, START) for s in "ab" for h in range(90 * 24)]
    load_all = spark.createDataFrame(hours, DEMAND).withColumn("generation_mw", F.col("demand_mw") * 2)
    store.append(load_all, "bronze_demand")
    # Of the newest days of silver every second one is not full, and two have no weather at all.
    partly = F.dayofyear(HOUR) % 2 == 0
    silver = load_all.withColumn("temp_c", F.when(~partly | (F.hour(HOUR) < 5), F.col("demand_mw") + 1)).where("series_id = 'a'")
    store.append(silver, SILVER)
    forecast = load_all.select("series_id", HOUR, F.col("demand_mw").alias("yhat"), F.lit("r").alias("run_id"))
    store.append(forecast, "gold_forecasts")
    assert len(store.days(SILVER)) == 90 and store.days(SILVER)[0] == (START + timedelta(days=89)).date()
    reports = [
        (A.daily_demand, 7), (A.efficiency_daily, 7), (A.forecast_daily, 7), (A.temp_demand_corr, 14),
    ]
    for report, read in reports:
        found = report(store, limit=7)
        whole = report({n: store[n] for n in ("bronze_demand", SILVER, "gold_forecasts")}, limit=7)
        assert silver_rows(found) == silver_rows(whole)
        assert len(silver_rows(found)) == 7
        days = "PartitionFilters" in found._jdf.queryExecution().executedPlan().toString()
        assert days and len(scanned_days(found)) >= 7
        filters = [str(d) for d in store.days(SILVER)[:read]]
        assert filters[-1] in found._jdf.queryExecution().executedPlan().toString()
    by = A.daily_demand(store, by=["series_id"], limit=5)
    assert silver_rows(by) == silver_rows(A.daily_demand({"bronze_demand": store["bronze_demand"]}, by=["series_id"], limit=5))
    assert A.daily_demand(store, limit=500).count() == 90 and A.daily_demand(store, limit=None).count() == 90


def test_facts_follow_every_write(spark, tmp_path):
    from hourwatt.sources.facts import day_facts

    store = TableStore(spark, str(tmp_path), facts=True)

    def agree(table="bronze_demand"):
        kept, true = store.facts(table), day_facts(store.read(table), table)
        assert silver_rows(kept) == silver_rows(true.select(*kept.columns))
        assert "bronze_demand/v" not in kept._jdf.queryExecution().executedPlan().toString().replace("_facts/bronze_demand/v", "")

    rows = lambda *r: spark.createDataFrame([(s, START + timedelta(hours=h), v, START) for s, h, v in r], DEMAND)
    store.append(rows(("a", 0, 1.0), ("a", 30, None)), "bronze_demand")
    agree()
    store.append(rows(("a", 0, 2.0), ("b", 55, 3.0)), "bronze_demand")  # a repeated key
    agree()
    assert store.facts("bronze_demand").agg(F.sum("duplicate_keys")).first()[0] == 1
    store.refresh(rows(("a", 30, 4.0), ("a", 90, 5.0)), "bronze_demand", "loaded_at")
    agree()
    store.replace(rows(("c", 0, 1.0)), "bronze_demand")
    agree()
    # A run that is lost between its days and their facts: the days are read anew.
    lost = store._facts_follow("bronze_demand", [START.date()])
    lost.__enter__()
    store.keeps_facts = False
    store.append(rows(("d", 5, 8.0)), "bronze_demand")
    store.keeps_facts = True
    assert store.facts("bronze_demand").agg(F.sum("row_count")).first()[0] == 2


def test_gate_on_facts_gives_the_verdicts_of_rows(spark, tmp_path):
    from hourwatt.operators.quality import quality_gate
    from hourwatt.sources.sample import AS_OF

    t, store = SampleTables(spark, "/root/testdata/sf0.001"), TableStore(spark, str(tmp_path), facts=True)
    spike = t["bronze_demand"].limit(1).withColumn("demand_mw", F.lit(1e6))
    tables = {n: t[n] for n in t} | {"bronze_demand": t["bronze_demand"].unionByName(spike)}
    for name, df in tables.items():
        store.append(df, name)
    from_facts, from_rows = quality_gate(store, AS_OF), quality_gate(tables, AS_OF)
    assert silver_rows(from_facts) == silver_rows(from_rows)
    outliers = {r.check_name: r.value for r in from_facts.collect()}["outlier_pct"]
    n = A.known_demand(tables).count()
    assert outliers == pytest.approx(100 * A.demand_outliers(tables, limit=None).count() / n) and outliers > 0
    scans = from_facts._jdf.queryExecution().optimizedPlan().toString()
    assert scans.count("Relation [series_id") == 1  # no table of rows, but for the outlier's day
