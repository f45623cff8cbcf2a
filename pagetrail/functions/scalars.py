"""Scalar expressions shared by the reports. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def domain(url: Column) -> Column:
    """Text between ``://`` and the next ``/`` with every ``www.`` removed.

    Deliberately not ``parse_url``: user-info and port stay, case is kept, a URL
    without a slash after the host gives ``''``, and one without ``://`` loses its
    first two characters.
    """
    rest = F.replace(F.substr(url, F.instr(url, "://") + F.lit(3)), F.lit("www."), F.lit(""))
    slash = F.instr(rest, "/")
    return F.when(slash == 0, F.lit("")).when(slash > 0, F.substring_index(rest, "/", 1))


def blank_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def _half_up(value: Column, unit: int) -> Column:
    """Integer division rounding halves away from zero; exact, unlike rounding a double."""
    half = F.when(value < 0, F.lit(-unit // 2)).otherwise(F.lit(unit // 2))
    return F.call_function("div", F.try_add(value, half), F.lit(unit))


def seconds_1dp(micros: Column) -> Column:
    """Microseconds as seconds with one decimal."""
    return _half_up(micros, 100_000) / F.lit(10.0)


def hours_2dp(micros: Column) -> Column:
    """Microseconds as hours with two decimals."""
    return _half_up(micros, 36_000_000) / F.lit(100.0)


def real_text(value: Column) -> Column:
    """A double as plain decimal text with at most 15 significant digits (``12345678.9``, ``0.975``)."""
    short = F.when(value.isNotNull(), F.format_string("%.14e", value).cast("double"))
    size = F.abs(short)
    plain = F.regexp_replace(short.cast("decimal(38,20)").cast("string"), "0+$", "")
    fixed_point = (size == 0) | ((size >= 1e-4) & (size < 1e15))
    return F.when(fixed_point, F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)).otherwise(
        short.cast("string")
    )
