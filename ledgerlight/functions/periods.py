"""Plain date parameters: spans, shifts, months. No Spark involved."""

from __future__ import annotations

import calendar
import datetime as dt

Day = dt.date | str


def as_day(value: Day) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def previous_span(start: Day, end: Day) -> tuple[dt.date, dt.date]:
    """Span of the same number of days that ends the day before ``start``."""
    first, last = as_day(start), as_day(end)
    length = (last - first).days + 1
    return first - dt.timedelta(days=length), first - dt.timedelta(days=1)


def month_key(value: Day) -> str:
    return as_day(value).strftime("%Y-%m")


def month_span(value: Day) -> tuple[dt.date, dt.date]:
    day = as_day(value)
    last = calendar.monthrange(day.year, day.month)[1]
    return day.replace(day=1), day.replace(day=last)


def last_days(as_of: Day, days: int = 7) -> tuple[dt.date, dt.date]:
    end = as_day(as_of)
    return end - dt.timedelta(days=days), end


def month_slices(first_year: int, last_year: int, per_year: int = 12) -> list[tuple[dt.date, dt.date]]:
    """Equal month groups covering whole years, for partitioned source reads."""
    if 12 % per_year:
        raise ValueError("per_year must divide 12")
    step = 12 // per_year
    return [
        (dt.date(year, month, 1), month_span(dt.date(year, month + step - 1, 1))[1])
        for year in range(first_year, last_year + 1)
        for month in range(1, 13, step)
    ]
