"""The three numeric time encodings browsers use, date bounds on them, and local-time text.

Bounds are computed on the driver *in the column's own encoding*, so a date filter
is a bare ``column >= literal`` that Parquet row-group statistics can answer.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: seconds from each family's epoch to 1970-01-01 UTC
CHROMIUM_EPOCH_SECONDS = 11_644_473_600  # 1601-01-01
SAFARI_EPOCH_SECONDS = 978_307_200  # 2001-01-01
DAY_SECONDS = 86_400

# fixed values: Unix seconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59 UTC
FIRST_SECOND = -62_135_596_800
LAST_SECOND = 253_402_300_799

# fixed value: SQLite asks the C library for the local offset only up to 2038-01-18
LOCALTIME_LAST_SECOND = 2_147_385_600

# fixed value: the Julian-day milliseconds of 1970-01-01, SQLite's internal time base
JULIAN_UNIX_EPOCH_MS = 210_866_760_000_000


@dataclass(frozen=True)
class TimeEncoding:
    """``raw = (unix_seconds + shift) * units``; ``real`` marks floating-point seconds."""

    shift: int
    units: int
    real: bool = False

    def raw(self, unix_seconds: int) -> int:
        return (unix_seconds + self.shift) * self.units

    @property
    def raw_hour(self) -> int:
        return 3600 * self.units

    def unix_seconds(self, raw: Column) -> Column:
        """Whole Unix seconds, with the truncation SQLite applies to each type."""
        if self.real:
            julian_ms = F.floor((raw - F.lit(float(self.shift))) * 1000.0 + float(JULIAN_UNIX_EPOCH_MS) + 0.5)
            return F.floor(F.try_subtract(julian_ms, F.lit(JULIAN_UNIX_EPOCH_MS)) / 1000.0)
        return F.call_function("div", raw, F.lit(self.units)) - F.lit(self.shift)


CHROMIUM_TIME = TimeEncoding(shift=CHROMIUM_EPOCH_SECONDS, units=1_000_000)
FIREFOX_TIME = TimeEncoding(shift=0, units=1_000_000)
SAFARI_TIME = TimeEncoding(shift=-SAFARI_EPOCH_SECONDS, units=1, real=True)


def midnight(date: str, tz: str) -> int:
    """Unix seconds of local midnight on a strict YYYY-MM-DD date."""
    try:
        day = datetime.strptime(date, "%Y-%m-%d")
    except (TypeError, ValueError):
        day = None
    if day is None or len(date) != 10:
        raise ValueError(f"invalid date {date!r}: use YYYY-MM-DD")
    return int(day.replace(tzinfo=ZoneInfo(tz)).timestamp())


def date_bounds(
    encoding: TimeEncoding, date_from: str | None, date_to: str | None, tz: str
) -> tuple[int | None, int | None]:
    """Half-open raw range covering both days; the end is the last midnight plus a fixed 24 hours."""
    low = None if date_from is None else encoding.raw(midnight(date_from, tz))
    high = None if date_to is None else encoding.raw(midnight(date_to, tz) + DAY_SECONDS)
    return low, high


def in_dates(
    column: Column, encoding: TimeEncoding, date_from: str | None, date_to: str | None, tz: str
) -> Column | None:
    """Range predicate on the raw column, or None when neither bound is given."""
    low, high = date_bounds(encoding, date_from, date_to, tz)
    literal = (lambda v: F.lit(float(v))) if encoding.real else F.lit
    tests = []
    if low is not None:
        tests.append(column >= literal(low))
    if high is not None:
        tests.append(column < literal(high))
    if not tests:
        return None
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def _add(unit: str, amount: Column, timestamp: Column) -> Column:
    return F.timestamp_add(unit, amount, timestamp)


def local_time(unix_seconds: Column, tz: str) -> Column:
    """Zone-free local timestamp of a Unix time; NULL outside years 1 to 9999.

    Outside 1970..2038 SQLite takes the zone offset of the matching year in a
    2000..2003 leap cycle instead of the historic one; never-visited Chromium rows
    (time 0 = the year 1601) show it, so it is reproduced.
    """
    valid = F.when(unix_seconds.between(FIRST_SECOND, LAST_SECOND), unix_seconds)
    utc = _add("SECOND", valid, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if tz == "UTC":
        return utc

    def zoned(ts: Column) -> Column:
        return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)

    year = F.year(utc)
    cycle = _add("YEAR", F.lit(2000) + year % 4 - year, utc)
    borrowed = _add("SECOND", F.timestamp_diff("SECOND", cycle, zoned(cycle)), utc)
    return F.when(unix_seconds.between(0, LOCALTIME_LAST_SECOND), zoned(utc)).otherwise(borrowed)


def local_text(raw: Column, encoding: TimeEncoding, tz: str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` in ``tz``; a cast, because date_format would use the session zone."""
    return local_time(encoding.unix_seconds(raw), tz).cast("string")
