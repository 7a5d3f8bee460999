"""Date and time expressions. "Today" is always an argument."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: date | datetime) -> Column:
    """A timestamp literal without a zone, whatever the session zone is."""
    if not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    return F.to_timestamp_ntz(F.lit(moment.isoformat(sep=" ")))


def day_literal(day: date) -> Column:
    return F.to_date(F.lit(day.isoformat()))


def month_label(moment: Column) -> Column:
    """``yyyy-MM`` text of a date or timestamp."""
    return F.date_format(moment, "yyyy-MM")


def day_label(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def shift_months(day: date, months: int) -> date:
    """The first day of the month ``months`` after the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def month_end(day: date, months: int = 0) -> date:
    """The last day of the month ``months`` after the month of ``day``."""
    return shift_months(day, months + 1) - timedelta(days=1)


def on_day(moment: Column, day: date) -> Column:
    """True on one day, as a range so that scans can skip files and partitions."""
    return (moment >= ntz(day)) & (moment < ntz(day + timedelta(days=1)))


def in_hour(moment: Column, hour: datetime) -> Column:
    start = hour.replace(minute=0, second=0, microsecond=0)
    return (moment >= ntz(start)) & (moment < ntz(start + timedelta(hours=1)))


def in_days(moment: Column, start: date, end: date) -> Column:
    """True from the start of ``start`` up to, not including, ``end``."""
    return (moment >= ntz(start)) & (moment < ntz(end))


def clock_label(moment: Column) -> Column:
    """``HH:mm:ss`` text. Cut from the text form, as ``date_format`` would apply the session zone's clock changes."""
    return F.substring(moment.cast("string"), 12, 8)


def hour_start(moment: Column) -> Column:
    """The full hour of a timestamp, whatever the session zone is."""
    return F.to_timestamp_ntz(F.concat(F.substring(moment.cast("string"), 1, 13), F.lit(":00:00")))


def clock_seconds(clock: Column) -> Column:
    """Seconds since midnight of an ``HH:mm:ss`` text; NULL where it is no time."""
    valid = clock.rlike("^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$")
    hours, minutes, seconds = (F.substring(clock, at, 2).cast("int") for at in (1, 4, 7))
    return F.when(valid, hours * 3600 + minutes * 60 + seconds)
