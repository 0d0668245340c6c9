"""Checks that a refresh has to pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwatt.functions import numbers as N
from hourwatt.functions import times as TM
from hourwatt.operators import analytics as A
from hourwatt.operators.analytics import Tables
from hourwatt.operators.grid import HOUR
from hourwatt.schemas import KEYS
from hourwatt.sources.facts import day_facts


@dataclass(frozen=True)
class Limits:
    min_rows: int = 1
    max_missing_pct: float = 10.0
    max_lag_hours: float = 72.0
    max_outlier_pct: float = 5.0
    max_duplicate_keys: int = 0
    max_rejected_pct: float = 1.0
    max_unsolved_hours: int = 0


class QualityError(Exception):
    """A refresh broke one of its limits."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def facts_of(tables: Tables, name: str, keys: Mapping[str, list[str]] = KEYS) -> DataFrame:
    """Facts of a table's days: those stored when it was written, or else made from its rows."""
    stored = getattr(tables, "facts", None)
    if stored is not None and keys[name] == KEYS[name]:
        return stored(name)
    return day_facts(tables[name], name, keys[name])


def table_facts(tables: Tables, as_of: datetime, keys: Mapping[str, list[str]]) -> DataFrame:
    """Rows, repeated keys and age of each table, from the facts of its days."""
    facts = []
    for name in A.ALL_TABLES:
        facts.append(
            facts_of(tables, name, keys).agg(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum("duplicate_keys"), F.lit(0)).alias("duplicate_keys"),
                F.max("latest_data").alias("latest_data"),
            )
        )
    lag = F.unix_timestamp(TM.at(as_of)) - F.unix_timestamp("latest_data")
    return reduce(DataFrame.unionByName, facts).withColumn("lag_hours", lag / F.lit(3600.0))


def missing_share(tables: Tables, name: str, keys: Mapping[str, list[str]]) -> DataFrame:
    """Share of rows without the measured value, in percent."""
    total, known = F.sum("row_count"), F.sum("known")
    found = facts_of(tables, name, keys).agg(N.percent(total - known, total, 2).alias("missing_pct"))
    return found.select(F.lit(name).alias("table_name"), "missing_pct")


def outlier_share(tables: Tables, keys: Mapping[str, list[str]]) -> DataFrame:
    """Share of demand values more than three deviations from the mean, in percent.

    Mean, deviation and extremes come from the facts; only days whose lowest or highest value lies that far out
    are counted row by row. Their list is as long as the table has such days.
    """
    name = "bronze_demand"
    facts = facts_of(tables, name, keys)
    n, total, squares = (F.sum(c) for c in ("known", "total", "squares"))
    around = F.greatest(squares - F.try_divide(total * total, n), F.lit(0.0))
    spread = F.sqrt(F.try_divide(around, n - 1))
    whole = facts.agg(n.alias("n"), F.try_divide(total, n).alias("mean"), spread.alias("sd")).first()
    count = F.lit(0)
    if whole.n and whole.sd:
        low, high = (whole.mean + k * A.OUTLIER_Z * whole.sd for k in (-1, 1))
        far = facts.where((F.col("low") < low) | (F.col("high") > high))
        days = [r[0] for r in far.select("event_date").distinct().collect()]
        if days:
            rows = A.known_demand(tables)
            day = F.col("event_date") if "event_date" in rows.columns else F.to_date(HOUR)
            rows = rows.where(day.isin(days))
            score = N.z_score(F.col("demand_mw"), F.lit(whole.mean), F.lit(whole.sd))
            count = rows.agg(F.count_if(score > A.OUTLIER_Z)).scalar()
    share = F.coalesce(F.try_divide(F.lit(100.0) * count, F.sum("known")), F.lit(0.0))
    found = facts.agg(share.alias("outlier_pct"))
    return found.select(F.lit(name).alias("table_name"), "outlier_pct")


def _checks(df: DataFrame, rules: Sequence[tuple[str, float, str]]) -> DataFrame:
    """Rows of checks from ``(column, limit, ">=" or "<=")``; a missing value fails."""
    cells = []
    for column, limit, sign in rules:
        value = F.col(column).cast("double")
        ok = value >= limit if sign == ">=" else value <= limit
        cells.append(
            F.struct(
                F.lit(column).alias("check_name"),
                value.alias("value"),
                F.lit(float(limit)).alias("limit_value"),
                F.coalesce(ok, F.lit(False)).alias("passed"),
            )
        )
    return df.select("table_name", F.inline(F.array(*cells)))


def quality_gate(
    tables: Tables,
    as_of: datetime,
    limits: Limits = Limits(),
    keys: Mapping[str, list[str]] = KEYS,
    landed: Sequence[DataFrame] = (),
) -> DataFrame:
    """One row per check and table. A table without rows fails its row count.

    Reads the facts of days, which a store that keeps them has from its writes.

    ``landed`` has the counts of landed and rejected rows of the feeds. Hours of the newest
    dispatch run without an optimal plan are counted too.
    """
    facts = table_facts(tables, as_of, keys)
    rows = [
        ("row_count", limits.min_rows, ">="),
        ("duplicate_keys", limits.max_duplicate_keys, "<="),
        ("lag_hours", limits.max_lag_hours, "<="),
    ]
    late = F.col("check_name") == "lag_hours"  # gold tables lie ahead of the clock
    newest = A.one_run(facts_of(tables, "gold_dispatch", keys))
    plans = newest.agg(
        F.lit("gold_dispatch").alias("table_name"),
        F.coalesce(F.sum("unsolved"), F.lit(0)).alias("unsolved_hours"),
    )
    gaps = [("missing_pct", limits.max_missing_pct, "<=")]
    parts = [
        _checks(plans, [("unsolved_hours", limits.max_unsolved_hours, "<=")]),
        _checks(facts, rows).where(~late | F.col("table_name").isin(*A.CORE_TABLES)),
        *[_checks(missing_share(tables, n, keys), gaps) for n in ("bronze_demand", "bronze_weather")],
        _checks(outlier_share(tables, keys), [("outlier_pct", limits.max_outlier_pct, "<=")]),
    ]
    for counts in landed:
        lost = F.coalesce(F.try_divide(100.0 * F.col("rows_rejected"), F.col("rows_landed")), F.lit(0.0))
        found = counts.select("table_name", lost.alias("rejected_pct"))
        parts.append(_checks(found, [("rejected_pct", limits.max_rejected_pct, "<=")]))
    return reduce(DataFrame.unionByName, parts)


def enforce(checks: DataFrame) -> None:
    """Raise if a check failed; there is one row per check and table."""
    failed = checks.where(~F.col("passed")).collect()
    if failed:
        text = "; ".join(f"{r.table_name}.{r.check_name} = {r.value}" for r in failed)
        raise QualityError(text)
