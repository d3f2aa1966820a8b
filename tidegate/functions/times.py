"""Time arithmetic: boundary differences, business dates, working minutes.

Storage is UTC. The business day is UTC+10 all year round (no daylight
saving), so it is a plain ten-hour shift rather than a named time zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.numbers import _col, round_dec

BUSINESS_OFFSET = "INTERVAL 10 HOURS"


def as_date(d: Column | str | dt.date) -> Column:
    """Accept a column, an ISO string or a date object as a date column."""
    if isinstance(d, Column):
        return d.cast("date")
    return F.lit(dt.date.fromisoformat(d) if isinstance(d, str) else d)


def as_timestamp(t: Column | str | dt.datetime) -> Column:
    """A UTC wall-clock literal. It has no zone, so comparing it with a stored
    time leaves the column bare and the predicate reaches the scan."""
    if isinstance(t, Column):
        return t
    if isinstance(t, dt.datetime):
        if t.tzinfo is not None:
            t = t.astimezone(dt.timezone.utc).replace(tzinfo=None)
        t = t.isoformat(sep=" ")
    return F.lit(t).cast("timestamp_ntz")


def on_day(c: Column | str, run_date) -> Column:
    """The column falls on the date, as a range the scan can use."""
    d = as_date(run_date)
    return (_col(c) >= d) & (_col(c) < F.date_add(d, 1))


def in_month(c: Column | str, month) -> Column:
    first = F.trunc(as_date(month), "month")
    return (_col(c) >= first) & (_col(c) < F.add_months(first, 1))


def to_business_time(c: Column | str) -> Column:
    return _col(c) + F.expr(BUSINESS_OFFSET)


def business_date(c: Column | str) -> Column:
    return F.to_date(to_business_time(c))


def _seconds(c: Column | str) -> Column:
    return F.unix_seconds(_col(c).cast("timestamp"))


def _micros(c: Column | str) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    return round_dec((_micros(end) - _micros(start)) / 86_400_000_000, 2)


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    return round_dec((_micros(end) - _micros(start)) / 3_600_000_000, 2)


def boundary_diff(unit: str, start: Column | str, end: Column | str) -> Column:
    """Number of unit boundaries crossed, the way warehouses count DATEDIFF."""
    start, end = _col(start), _col(end)
    if unit == "day":
        return F.datediff(F.to_date(end), F.to_date(start))
    if unit == "month":
        return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    width = {"minute": 60, "hour": 3600}[unit]
    return F.floor(_seconds(end) / width) - F.floor(_seconds(start) / width)


def floor_hour(c: Column | str) -> Column:
    return F.date_trunc("hour", _col(c)).cast("timestamp_ntz")


def previous_hour(c: Column | str) -> Column:
    return floor_hour(c) - F.expr("INTERVAL 1 HOUR")


def month_label(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def iso_week(c: Column | str) -> Column:
    c = _col(c)
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), c).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(c).cast("string"), 2, "0"),
    )


def iso_week_label(d: str | dt.date) -> str:
    """Driver-side twin of :func:`iso_week`, for output paths."""
    d = dt.date.fromisoformat(d) if isinstance(d, str) else d
    year, week, _ = d.isocalendar()
    return f"{year}-W{week:02d}"


def in_window(c: Column | str, start, end) -> Column:
    """Half-open window ``[start, end)``."""
    c = _col(c)
    return (c >= as_timestamp(start)) & (c < as_timestamp(end))


def trailing_week(c: Column | str, run_date) -> Column:
    """Both ends inclusive; a timestamp therefore stops at midnight of the run date."""
    d = as_date(run_date)
    return _col(c).between(F.date_sub(d, 7), d)


def effective_on(run_date, start: str = "effective_from", end: str = "effective_to") -> Column:
    d = as_date(run_date)
    return (F.col(start) <= d) & (F.col(end).isNull() | (F.col(end) > d))


def asset_age_years(installed: Column | str, run_date) -> Column:
    return round_dec(F.datediff(as_date(run_date), _col(installed)) / F.lit(365.25), 2)


OPENS_MINUTE = 8 * 60
CLOSES_MINUTE = 18 * 60


def _working_minutes_before(c: Column, holidays: list[dt.date]) -> Column:
    """Working minutes from the epoch up to ``c``: a prefix sum in closed form.

    1970-01-05 was a Monday, so whole weeks since then contribute five days
    each; a weekday holiday before the date takes one day back.
    """
    day = F.to_date(c)
    since_monday = F.datediff(day, F.lit(dt.date(1970, 1, 5)))
    weeks = F.floor(since_monday / 7)
    weekday = since_monday - weeks * 7
    days = weeks * 5 + F.least(weekday, F.lit(5))
    is_open = weekday < 5
    # One comparison per holiday keeps the expression inside generated code.
    for h in holidays:
        days = days - (day > F.lit(h)).cast("int")
        is_open = is_open & (day != F.lit(h))
    minute = F.floor(_seconds(c) / 60) - F.unix_date(day).cast("long") * 1440
    inside = F.least(F.greatest(minute - OPENS_MINUTE, F.lit(0)), F.lit(CLOSES_MINUTE - OPENS_MINUTE))
    return days * (CLOSES_MINUTE - OPENS_MINUTE) + F.when(is_open, inside).otherwise(0)


def business_minutes(
    start: Column | str,
    end: Column | str,
    holidays: Iterable[dt.date | str] = (),
    paused: Column | str | None = None,
) -> Column:
    """Minutes between two times that fall on Mon-Fri 08:00-18:00, less a pause.

    The difference of two prefix sums, so it needs neither a calendar join nor
    a Python function. Null when either end is missing.
    """
    days = sorted(dt.date.fromisoformat(h) if isinstance(h, str) else h for h in set(holidays))
    days = [d for d in days if d.weekday() < 5]
    start, end = _col(start), _col(end)
    net = _working_minutes_before(end, days) - _working_minutes_before(start, days)
    if paused is not None:
        net = net - F.coalesce(_col(paused), F.lit(0))
    return F.when(start.isNotNull() & end.isNotNull(), F.greatest(net, F.lit(0)).cast("long"))
