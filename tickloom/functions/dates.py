"""Date and time functions; a ``zone`` reads a UTC timestamp on that zone's clock."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.core import SECOND, col, from_micros, micros

# Format directives and the pattern letters they stand for.
_DIRECTIVES = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "p": "a",
    "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "j": "DDD", "q": "SSS", "J": "SSSSSSSSS",
}


def java_pattern(fmt: str, parsing: bool = False) -> str:
    """A ``%Y-%m-%d`` style format as a Spark datetime pattern.

    For parsing, numbers may miss their leading zero where no digit follows them directly.
    """
    pieces, out = re.findall(r"%(.)|([^%]+)", fmt), []
    for i, (directive, literal) in enumerate(pieces):
        if not directive:
            out.append(re.sub(r"([A-Za-z]+)", r"'\1'", literal))
            continue
        if directive not in _DIRECTIVES:
            raise ValueError(f"unknown directive %{directive}")
        pattern = _DIRECTIVES[directive]
        alone = (i + 1 == len(pieces) or not pieces[i + 1][0]) and (i == 0 or not pieces[i - 1][0])
        out.append(pattern[0] if parsing and alone and directive in "mdHIMS" else pattern)
    return "".join(out)


def local(c: str | Column, zone: str | None = None) -> Column:
    return F.from_utc_timestamp(col(c), zone).cast("timestamp_ntz") if zone else col(c)


def strftime(c: str | Column, fmt: str, zone: str | None = None) -> Column:
    return F.date_format(local(c, zone), java_pattern(fmt))


def to_datetime(c: str | Column, fmt: str | None = None, zone: str | None = None, unit: str | None = None) -> Column:
    """Parse a text by format (NULL if it does not fit), or read it as milliseconds since 1970.

    ``unit='ns'`` keeps the fraction of the millisecond, to Spark's microseconds.
    """
    if unit is not None:
        millis = col(c).try_cast("decimal(38,6)")
        us = F.floor(millis * 1000) if unit == "ns" else F.floor(millis) * 1000
        return from_micros(us.cast("long"))
    parsed = F.try_to_timestamp(col(c), F.lit(java_pattern(fmt, parsing=True))).cast("timestamp_ntz")
    return F.to_utc_timestamp(parsed, zone).cast("timestamp_ntz") if zone else parsed


def date(c: str | Column, zone: str | None = None) -> Column:
    return F.to_date(local(c, zone))


def year(c: str | Column, zone: str | None = None) -> Column:
    return F.year(local(c, zone)).cast("long")


def quarter(c: str | Column, zone: str | None = None) -> Column:
    return F.quarter(local(c, zone)).cast("long")


def month(c: str | Column, zone: str | None = None) -> Column:
    return F.month(local(c, zone)).cast("long")


def month_name(c: str | Column, zone: str | None = None) -> Column:
    return F.date_format(local(c, zone), "MMM")


def week(c: str | Column, zone: str | None = None) -> Column:
    """Week of the year, weeks starting on Sunday and counted from the one with January 1."""
    t = local(c, zone)
    january = F.dayofweek(F.trunc(F.to_date(t), "year")) - 1
    return (F.floor((F.dayofyear(t) + january - 1) / 7) + 1).cast("long")


def day_of_week(c: str | Column, start_index: int = 1, start_day: str = "monday", zone: str | None = None) -> Column:
    if start_day not in ("monday", "sunday"):
        raise ValueError("start_day is 'monday' or 'sunday'")
    since = (F.dayofweek(local(c, zone)) + (5 if start_day == "monday" else 6)) % 7
    return (since + start_index).cast("long")


def day_name(c: str | Column, zone: str | None = None) -> Column:
    return F.date_format(local(c, zone), "EEEE")


def day_of_month(c: str | Column, zone: str | None = None) -> Column:
    return F.dayofmonth(local(c, zone)).cast("long")


def day_of_year(c: str | Column, zone: str | None = None) -> Column:
    return F.dayofyear(local(c, zone)).cast("long")


def hour(c: str | Column, zone: str | None = None) -> Column:
    return F.hour(local(c, zone)).cast("long")


def minute(c: str | Column, zone: str | None = None) -> Column:
    return F.minute(local(c, zone)).cast("long")


def second(c: str | Column, zone: str | None = None) -> Column:
    return F.floor(F.second(local(c, zone))).cast("long")


def date_trunc(part: str | Column, c: str | Column, zone: str | None = None) -> Column:
    """Truncate to a unit, constant or per row; weeks start on Sunday."""
    t = local(c, zone)
    day = F.expr("INTERVAL 1 DAY")
    if isinstance(part, str):
        if part == "nanosecond":
            out = t
        elif part == "week":
            out = F.date_trunc("week", t + day).cast("timestamp_ntz") - day
        else:
            out = F.date_trunc(part, t).cast("timestamp_ntz")
    else:
        units = ("year", "quarter", "month", "week", "day", "hour", "minute", "second", "millisecond")
        out = None
        for u in units:
            cut = date_trunc(u, t)
            out = F.when(part == u, cut) if out is None else out.when(part == u, cut)
        out = out.when(part == "nanosecond", t.cast("timestamp_ntz"))
    return F.to_utc_timestamp(out, zone).cast("timestamp_ntz") if zone else out


# Microseconds of the units whose length never changes.
_UNIT_US = {
    "Week": 7 * 24 * 3600 * SECOND, "Day": 24 * 3600 * SECOND, "Hour": 3600 * SECOND, "Minute": 60 * SECOND,
    "Second": SECOND, "Milli": 1000, "Micro": 1,
}
_CALENDAR = {"Year": 12, "Quarter": 3, "Month": 1}


def add(c: str | Column, unit: str, n: int | Column) -> Column:
    """``ts + Unit(n)``; years, quarters and months keep the day of month where they can."""
    n = (F.lit(n) if isinstance(n, int) else n).cast("long")
    if unit in _CALENDAR:
        return F.timestamp_add("MONTH", n * _CALENDAR[unit], col(c))
    if unit == "Nano":
        return F.timestamp_add("MICROSECOND", F.floor(n / 1000).cast("long"), col(c))
    return F.timestamp_add("MICROSECOND", n * F.lit(_UNIT_US[unit]).cast("long"), col(c))


def difference(unit: str, a: str | Column, b: str | Column) -> Column:
    """``Unit(a - b)``: whole units between two times, truncated."""
    if unit in _CALENDAR:
        months = F.timestamp_diff("MONTH", col(b), col(a))
        return ((months - months % _CALENDAR[unit]) / _CALENDAR[unit]).cast("long")
    if unit == "Nano":
        return (micros(a) - micros(b)) * 1000
    gap = micros(a) - micros(b)
    return ((gap - gap % _UNIT_US[unit]) / _UNIT_US[unit]).cast("long")
