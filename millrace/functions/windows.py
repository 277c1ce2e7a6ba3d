"""Event-time windows as columns: fixed, calendar days, calendar months.

Windows are counted from 1970-01-01T00:00Z and expect TIMESTAMP columns in a
session whose zone is UTC.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_MINUTE = 60_000_000
_UNIT_MICROS = {"minute": _MINUTE, "hour": 60 * _MINUTE, "day": 1440 * _MINUTE}
_WEEK_DAYS = 7
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ZONED_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS zzz"

# The window types, each with its unit and count.
WINDOW_TYPES = {
    "FIVE_MINUTE": ("minute", 5),
    "TEN_MINUTE": ("minute", 10),
    "FIFTEEN_MINUTE": ("minute", 15),
    "THIRTY_MINUTE": ("minute", 30),
    "ONE_HOUR": ("hour", 1),
    "TWO_HOUR": ("hour", 2),
    "THREE_HOUR": ("hour", 3),
    "SIX_HOUR": ("hour", 6),
    "ONE_DAY": ("day", 1),
    "THREE_DAY": ("day", 3),
    "ONE_WEEK": ("week", 1),
    "TWO_WEEK": ("week", 2),
    "ONE_MONTH": ("month", 1),
}
# How a table suffix shows the start of a window, by unit.  The
# hour has no leading zero.
SUFFIX_FORMATS = {
    "minute": "yyyyMMdd_Hmm",
    "hour": "yyyyMMdd_Hmm",
    "day": "yyyyMMdd",
    "week": "yyyyMMdd",
    "month": "yyyyMM",
}


def floor_div(value: Column, by: int) -> Column:
    """Whole-number division towards minus infinity, exact for results below 2**53."""
    return ((value - F.pmod(value, F.lit(by))) / F.lit(by)).cast("bigint")


@dataclass(frozen=True)
class WindowSize:
    """``count`` units of ``minute``, ``hour``, ``day`` or ``month``."""

    unit: str
    count: int

    @property
    def longest_micros(self) -> int:
        if self.unit == "month":
            return 31 * self.count * _UNIT_MICROS["day"]
        return self.count * _UNIT_MICROS[self.unit]

    @property
    def interval(self) -> str:
        return f"{self.count} {self.unit}s"


def minutes(n: int) -> WindowSize:
    return WindowSize("minute", n)


def hours(n: int) -> WindowSize:
    return WindowSize("hour", n)


def days(n: int) -> WindowSize:
    return WindowSize("day", n)


def months(n: int) -> WindowSize:
    return WindowSize("month", n)


def window_size(window_type: str, mode: str = "nominal") -> WindowSize:
    """The size a window type stands for.

    ``nominal`` is what its name says.  ``literal`` takes the bare count of an
    hour type as minutes and that of a week type as days, for tables that were
    cut that way.
    """
    unit, count = WINDOW_TYPES[window_type]
    if mode not in ("nominal", "literal"):
        raise ValueError(f"unknown mode {mode}")
    if unit == "week":
        return days(count * (_WEEK_DAYS if mode == "nominal" else 1))
    if unit == "hour" and mode == "literal":
        return minutes(count)
    return WindowSize(unit, count)


def window_start(ts: Column, size: WindowSize) -> Column:
    if size.unit == "month":
        if size.count == 1:
            return F.date_trunc("month", ts)
        month_no = (F.year(ts) - 1970) * 12 + F.month(ts) - 1
        first = month_no - F.pmod(month_no, F.lit(size.count))
        return F.add_months(F.lit("1970-01-01").cast("date"), first).cast("timestamp")
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(size.longest_micros)))


def window_end(start: Column, size: WindowSize) -> Column:
    if size.unit == "month":
        return F.add_months(start.cast("date"), size.count).cast("timestamp")
    return F.timestamp_micros(F.unix_micros(start) + F.lit(size.longest_micros))


def window_for(ts: Column, size: WindowSize) -> Column:
    """The window a time falls in, as ``struct<start, end>``."""
    start = window_start(ts, size)
    return F.struct(start.alias("start"), window_end(start, size).alias("end"))


def window_by_type(ts: Column, window_type: str, mode: str = "nominal") -> Column:
    return window_for(ts, window_size(window_type, mode))


def window_suffix(start: Column, window_type: str) -> Column:
    """``20240103_905`` for minutes and hours, ``20240103`` for days and weeks,
    ``202401`` for months."""
    return F.date_format(start, SUFFIX_FORMATS[WINDOW_TYPES[window_type][0]])


def window_table(table: str, start: Column, window_type: str) -> Column:
    """The table that takes the rows of a window."""
    return F.concat(F.lit(f"{table}_"), window_suffix(start, window_type))


def window_text(window: Column) -> Column:
    """``[start..end)`` with both ends in ISO form, UTC, to the millisecond."""
    start, end = window["start"], window["end"]
    return F.concat(
        F.lit("["), F.date_format(start, ISO_MILLIS),
        F.lit(".."), F.date_format(end, ISO_MILLIS), F.lit(")"),
    )


def window_max_ts(end: Column) -> Column:
    """The last millisecond of a window, in ISO form."""
    return F.date_format(F.timestamp_micros(F.unix_micros(end) - 1000), ISO_MILLIS)


def pane_path(prefix: str, end: Column, pane_index: Column) -> Column:
    """``<prefix>/<last millisecond of the window>/<pane index>``."""
    return F.concat_ws("/", F.lit(prefix), window_max_ts(end), pane_index.cast("string"))


def zoned_text(ts: Column) -> Column:
    """``2024-01-03T09:05:00.000 UTC``."""
    return F.date_format(ts, ZONED_MILLIS)
