"""Calendar arithmetic around the weekly (Sunday) snapshot."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | dt.date


def as_date(value: DateLike) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def day(value: DateLike) -> Column:
    """A typed date literal, so comparisons prune partitions without casts."""
    return F.lit(as_date(value))


def add_months(value: DateLike, months: int) -> dt.date:
    """Same day `months` away, clipped to the month's last day."""
    start = as_date(value)
    year, month0 = divmod(start.year * 12 + start.month - 1 + months, 12)
    last_day = calendar.monthrange(year, month0 + 1)[1]
    return dt.date(year, month0 + 1, min(start.day, last_day))


def month_starts(value: DateLike, months: int) -> list[dt.date]:
    """First days of the last `months` months, newest first, the current one included."""
    this_month = as_date(value).replace(day=1)
    return [add_months(this_month, -i) for i in range(months)]


def require_sunday(value: DateLike) -> dt.date:
    """Snapshot gate: weekly jobs only run for a Sunday."""
    result = as_date(value)
    if result.weekday() != 6:
        raise ValueError(f"{result} is not a Sunday")
    return result


def require_new_year(value: DateLike) -> dt.date:
    """Snapshot gate: yearly jobs only run on 1 January."""
    result = as_date(value)
    if (result.month, result.day) != (1, 1):
        raise ValueError(f"{result} is not 1 January")
    return result


def last_sunday_before(value: Column) -> Column:
    """The Sunday strictly before the day."""
    return F.date_sub(value, F.weekday(value) + 1)


def eligible_sunday(value: Column) -> Column:
    """The newest snapshot that was published before the day.

    Snapshots appear on Wednesday, so Monday to Wednesday still see the one before last.
    """
    not_published = F.weekday(value) <= 2
    return F.date_sub(value, F.weekday(value) + F.when(not_published, 8).otherwise(1))


def sunday_on_or_before(value: Column) -> Column:
    return F.date_sub(value, F.dayofweek(value) - 1)


def week_sunday(value: Column) -> Column:
    """The Sunday that closes the day's Monday-to-Sunday week."""
    return F.date_add(value, F.lit(6) - F.weekday(value))


def days_since(value: Column, snapshot: DateLike) -> Column:
    return F.datediff(day(snapshot), value)


def is_weekend(value: Column) -> Column:
    return F.when(F.dayofweek(value).between(2, 6), 0).otherwise(1)


def is_daytime(timestamp: Column, start: int = 6, end: int = 18) -> Column:
    """True from `start` o'clock up to but not including `end` o'clock."""
    hour = F.hour(timestamp)
    return (hour >= start) & (hour < end)


def month_label(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM")


def iso_year(value: Column) -> Column:
    """The year that owns the day's ISO week."""
    return F.extract(F.lit("YEAROFWEEK"), value)
