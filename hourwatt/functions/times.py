"""Time expressions: feed hours, calendar parts, horizons, display text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
HOUR_FORMATS = ("yyyy-MM-dd'T'HH", "yyyyMMdd'T'HHX")
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
INVALID_DATE = "Invalid Date"


def feed_hour(text: Column) -> Column:
    """UTC hour of a feed period written in either of the two known ways; else null."""
    tries = [F.try_to_timestamp(text, F.lit(fmt)) for fmt in HOUR_FORMATS]
    return F.date_trunc("hour", F.coalesce(*tries))


def observed_hour(text: Column) -> Column:
    """Hour in which an observation time falls; null when the text is no time."""
    return floor_hour(text.try_cast("timestamp"))


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts.cast("timestamp"))


def day_of_week(ts: Column) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(ts)


def weekday(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def day_name(ts: Column) -> Column:
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return F.element_at(names, F.dayofweek(ts))


def hour_of_week(ts: Column) -> Column:
    """0 (Monday 00h) ... 167 (Sunday 23h)."""
    return F.weekday(ts) * 24 + F.hour(ts)


def at(as_of: datetime) -> Column:
    """The run's clock as a literal, so that a rerun gives the same rows."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def days_before(as_of: datetime, days: int) -> Column:
    return at(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def hour_of(as_of: datetime) -> Column:
    return F.date_trunc("hour", at(as_of))


def naive(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def display_time(text: Column) -> Column:
    """ISO text with or without zone, or with a blank between date and time; else null."""
    return F.coalesce(
        text.try_cast("timestamp"),
        F.concat(text, F.lit("Z")).try_cast("timestamp"),
        F.concat(F.regexp_replace(text, " ", "T"), F.lit("Z")).try_cast("timestamp"),
    )


def display_label(text: Column) -> Column:
    shown = F.date_format(display_time(text), "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(shown, F.lit(INVALID_DATE))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
