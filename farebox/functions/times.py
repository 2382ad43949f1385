"""Time expressions and time predicates.

Predicates compare the bare column with literals, so they reach the parquet scan as pushed filters.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.columns import as_column

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _moment(value: str | date | datetime) -> Column:
    """Literal wall-clock moment; a date means its midnight."""
    return F.lit(str(value)).cast("timestamp_ntz")


def _as_date(value: str | date) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


def minute_boundaries(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed between two moments: 10:00:59 to 10:01:01 is 1; negative when reversed."""
    floor_start, floor_end = F.date_trunc("minute", as_column(start)), F.date_trunc("minute", as_column(end))
    return F.timestamp_diff("MINUTE", floor_start, floor_end)


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Difference in hours from whole epoch seconds."""
    return (F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))) / F.lit(3600)


def month_start(col: Column | str) -> Column:
    return F.trunc(as_column(col), "month")


def day_of(col: Column | str) -> Column:
    return as_column(col).cast("date")


def parse_event_time(col: Column | str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Text to timestamp; text that does not fit becomes NULL instead of stopping a stream."""
    return F.try_to_timestamp(as_column(col), F.lit(fmt))


def in_half_open(col: Column | str, start, end) -> Column:
    """start <= col < end."""
    return (as_column(col) >= _moment(start)) & (as_column(col) < _moment(end))


def between_closed(col: Column | str, start, end) -> Column:
    """BETWEEN with date bounds: of the last day only midnight itself is inside."""
    return as_column(col).between(_moment(start), _moment(end))


def in_range_of_days(col: Column | str, first_day, last_day) -> Column:
    """All moments from the first day to the end of the last day."""
    return in_half_open(col, _as_date(first_day), _as_date(last_day) + timedelta(days=1))


def on_day(col: Column | str, day) -> Column:
    """Moments of one calendar day, as a range so that file statistics can be used."""
    return in_range_of_days(col, day, day)


def in_month(col: Column | str, month: str) -> Column:
    """Moments of a month given as 'MM-yyyy', as a range instead of formatting every row."""
    number, year = month.split("-")
    first = date(int(year), int(number), 1)
    return in_half_open(col, first, next_month(first))
