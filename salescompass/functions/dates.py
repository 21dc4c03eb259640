"""Date arithmetic with an explicit "now".

Every function takes the reference instant as an argument; nothing reads the clock.
Instants are TIMESTAMP_NTZ, so results do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value) -> Column:
    """Column, datetime, date or ISO text -> TIMESTAMP_NTZ column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def day(value) -> Column:
    """Column, datetime, date or ISO text -> DATE column."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def before(now, **amount: int) -> Column:
    """``now`` minus days / hours / mins, as an instant."""
    return instant(now) - F.make_dt_interval(**{unit: F.lit(n) for unit, n in amount.items()})


def months_before(now, months: int) -> Column:
    return F.add_months(day(now), -months)


def period_start(now, unit: str, back: int = 0) -> Column:
    """First day of the month / quarter / year holding ``now``, ``back`` periods earlier."""
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return F.trunc(F.add_months(day(now), -months * back), unit)


def days_between(earlier, later) -> Column:
    """Calendar-day boundaries crossed, not elapsed 24-hour spans."""
    return F.datediff(day(later), day(earlier))


def epoch_seconds(ts) -> Column:
    return F.timestamp_diff("SECOND", instant("1970-01-01 00:00:00"), instant(ts))


def seconds_between(earlier, later) -> Column:
    """Second boundaries crossed between two instants."""
    return epoch_seconds(later) - epoch_seconds(earlier)
