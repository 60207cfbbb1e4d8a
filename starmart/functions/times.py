"""Epoch and SAS dates, calendar parts. All built-in expressions, no Python worker."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar columns in table order, and the SAS day zero.
CALENDAR_PARTS = ["hour", "day", "week", "month", "year", "weekday"]
SAS_DAY_ZERO = date(1960, 1, 1)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def millis_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp that keeps the milliseconds."""
    return F.timestamp_millis(_col(ms))


def seconds_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp cut to whole seconds (towards 1970, as integer division does)."""
    ms = _col(ms)
    return F.timestamp_millis(ms - ms % 1000)


def calendar(ts: Column | str, parts: list[str] | None = None, week_start: str = "monday") -> list[Column]:
    """Calendar columns of a timestamp or date.

    ``week_start`` names the day numbered 0: ``"monday"`` or ``"sunday"``.
    ``week`` is the ISO week.
    """
    ts = _col(ts)
    weekday = {"monday": F.weekday(ts), "sunday": F.dayofweek(ts) - 1}[week_start]
    expressions = {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": weekday,
    }
    return [expressions[p].alias(p) for p in (parts or CALENDAR_PARTS)]


def sas_days_to_date(days: Column | str) -> Column:
    """Days since 1960-01-01 to a date; null for null, NaN or a date outside the years 1 to 9999."""
    n = _col(days).try_cast("int")
    lowest, highest = (date.min - SAS_DAY_ZERO).days, (date.max - SAS_DAY_ZERO).days
    return F.when(n.between(lowest, highest), F.date_add(F.lit(SAS_DAY_ZERO), n))
