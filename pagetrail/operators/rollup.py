"""Daily counts per page, which summaries of a date range read instead of visits.

A day is a UTC day. A range whose bounds lie within days takes the visits of those two days from the tables and all days
between them from the counts. Counts of different visits can be put together, so a day's are made once, when its visits
are landed, and late visits are added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.functions.timecodec import DAY_SECONDS, TimeEncoding, date_bounds
from pagetrail.operators.summary import LAYOUTS, Layout, Tables, added_up, page_counts, report
from pagetrail.schemas import PROFILE

DAY = "day"


def _units(encoding: TimeEncoding) -> int:
    return DAY_SECONDS * encoding.units


def day_of(raw: Column, encoding: TimeEncoding) -> Column:
    """The number of a raw time's UTC day in its own encoding, whose epochs all begin a day; exact at midnight."""
    units = _units(encoding)
    if encoding.real:
        guess = F.floor(raw / float(units))
        low = F.when(guess * float(units) > raw, guess - 1).otherwise(guess)
        return F.when((low + 1) * float(units) <= raw, low + 1).otherwise(low)
    return F.call_function("div", F.try_subtract(raw, F.pmod(raw, F.lit(units))), F.lit(units))


def _paged(tables: Tables, layout: Layout) -> DataFrame:
    return tables[layout.visits].withColumnRenamed(layout.page, "page")


def daily(tables: Tables, browser: str) -> DataFrame:
    """(profile_id, day, page, n, us, type_0...) of all visits; visits without a time have no day."""
    layout = LAYOUTS[browser]
    visits = _paged(tables, layout).withColumn(DAY, day_of(F.col(layout.time), layout.encoding))
    return page_counts(visits, layout, DAY)


def put_together(browser: str, *counts: DataFrame) -> DataFrame:
    """The counts of all visits behind several counts of different visits."""
    return added_up(reduce(DataFrame.unionByName, counts), LAYOUTS[browser], DAY)


def keep_daily(counts: DataFrame, browser: str, path: str) -> None:
    """Write counts by month, sorted by day, so that a range opens its months and skips the other row groups."""
    encoding = LAYOUTS[browser].encoding
    seconds = F.col(DAY) * DAY_SECONDS - encoding.shift
    month = F.substring(F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("string"), 1, 7)
    dated = counts.withColumn("month", F.coalesce(F.when(F.abs(seconds) < 2**37, month), F.lit("undated")))
    laid = dated.hint("rebalance", F.col("month")).sortWithinPartitions("month", DAY)
    laid.write.mode("overwrite").partitionBy("month").parquet(f"{path}/{browser}")


def kept_daily(spark: SparkSession, browser: str, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{browser}").drop("month")


def summary(
    counts: DataFrame,
    tables: Tables,
    browser: str,
    date_from: str | None = None,
    date_to: str | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """``operators.summary.summary`` of the same range, from the counts of its whole days and the visits at its ends."""
    layout = LAYOUTS[browser]
    units, time, day = _units(layout.encoding), F.col(layout.time), F.col(DAY)
    low, high = date_bounds(layout.encoding, date_from, date_to, tz)
    first = None if low is None else -(-low // units)
    last = None if high is None else high // units  # the first day that is not whole
    literal = (lambda v: F.lit(float(v))) if layout.encoding.real else F.lit
    if first is not None and last is not None and first >= last:
        whole, ends = F.lit(False), [(low, high)]
    else:
        whole = F.lit(True) if first is None else day >= first
        whole = whole if last is None else whole & (day < last)
        ends = [] if first is None or first * units == low else [(low, first * units)]
        ends += [] if last is None or last * units == high else [(last * units, high)]
    parts = [counts.where(whole).select(PROFILE, "page", *layout.counts)]
    if ends:
        within = reduce(Column.__or__, ((time >= literal(a)) & (time < literal(b)) for a, b in ends))
        parts.append(page_counts(_paged(tables, layout).where(within), layout))
    return report(added_up(reduce(DataFrame.unionByName, parts), layout), tables, browser)
