"""Summary reports: totals, top domains and visit types of the visits in a date range."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.functions.labels import (
    CHROMIUM_SUMMARY_CODES,
    CHROMIUM_TRANSITIONS,
    FIREFOX_VISIT_TYPES,
    chromium_transition_group,
    firefox_visit_type_group,
)
from pagetrail.functions.scalars import domain, hours_2dp, real_text
from pagetrail.functions.timecodec import CHROMIUM_TIME, FIREFOX_TIME, SAFARI_TIME, TimeEncoding, in_dates
from pagetrail.plans.newest import first_rows, keep, owner
from pagetrail.schemas import CHROMIUM_BROWSERS, PROFILE

Tables = Mapping[str, DataFrame]

TOP_DOMAINS = 10

#: Slots that domains are hashed into.
SLOTS = 1 << 16

BASIC, DOMAINS, TYPES = "basic", "domains", "types"


@dataclass(frozen=True)
class Layout:
    """Where one browser family keeps what a summary needs."""

    visits: str
    time: str
    page: str
    pages: str
    encoding: TimeEncoding
    duration: str | None = None
    label: Callable[[Column], Column] | None = None
    code: str | None = None
    types: tuple[str, ...] = ()
    types_title: str | None = None

    @property
    def totals(self) -> tuple[str, ...]:
        return ("total_visits", "unique_urls") + (("total_hours",) if self.duration else ())

    @property
    def counts(self) -> tuple[str, ...]:
        """The columns of ``page_counts``."""
        return ("n", *(("us",) if self.duration else ()), *(f"type_{i}" for i in range(len(self.types))))


_CHROMIUM = {"visits": "visits", "time": "visit_time", "page": "url", "pages": "urls", "encoding": CHROMIUM_TIME}

LAYOUTS = {
    **dict.fromkeys(CHROMIUM_BROWSERS, Layout(**_CHROMIUM, duration="visit_duration")),
    "chrome": Layout(
        **_CHROMIUM,
        duration="visit_duration",
        label=chromium_transition_group,
        code="transition",
        types=tuple(CHROMIUM_TRANSITIONS[code] for code in CHROMIUM_SUMMARY_CODES) + ("OTHER",),
        types_title="Transition Types",
    ),
    "firefox": Layout(
        visits="moz_historyvisits",
        time="visit_date",
        page="place_id",
        pages="moz_places",
        encoding=FIREFOX_TIME,
        label=firefox_visit_type_group,
        code="visit_type",
        types=(*FIREFOX_VISIT_TYPES.values(), "OTHER"),
        types_title="Visit Types",
    ),
    "safari": Layout(
        visits="history_visits",
        time="visit_time",
        page="history_item",
        pages="history_items",
        encoding=SAFARI_TIME,
    ),
}


def _layout(browser: str) -> Layout:
    if browser not in LAYOUTS:
        raise ValueError(f"browser must be one of {sorted(LAYOUTS)}, got {browser!r}")
    return LAYOUTS[browser]


def _visits(
    tables: Tables, layout: Layout, date_from: str | None, date_to: str | None, tz: str
) -> DataFrame:
    test = in_dates(F.col(layout.time), layout.encoding, date_from, date_to, tz)
    return keep(tables[layout.visits], test).withColumnRenamed(layout.page, "page")


def _total(duration: str) -> Column:
    """The sum of durations, as a decimal: microseconds of a large fleet do not fit 64 bits."""
    return F.sum(F.col(duration).cast("decimal(20,0)")).cast("decimal(38,0)")


def _page_bits() -> tuple[Column, Column]:
    """A page as a bit in one of its profile's 64-bit words.

    Databases number their pages densely, so distinct pages are counted from few words, and never from more words than
    pages; words of several tasks are merged by OR.
    """
    place = F.col("page").bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return F.shiftright("page", 6), F.when(F.col(PROFILE).isNotNull(), bit)


def _domains_of(tables: Tables, layout: Layout) -> DataFrame:
    """(profile_id, page, domain): the domain is cut out before the shuffle, not the whole URL carried."""
    return tables[layout.pages].select(PROFILE, F.col("id").alias("page"), domain(F.col("url")).alias("domain"))


def in_order(figures: DataFrame, *order: Column) -> DataFrame:
    """A report's few figures, one per label or reported domain, sorted without range partitioning, which would run
    the plan twice."""
    return figures.repartition(1).sortWithinPartitions(*order)


def basic(
    tables: Tables,
    browser: str,
    date_from: str | None = None,
    date_to: str | None = None,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """One row: visits, distinct pages and, where durations exist, hours. Unknown pages count.

    With ``per_profile`` one row for each profile that has a visit in the range, here and below.
    """
    layout = _layout(browser)
    word, bit = _page_bits()
    counts = {"n": F.count(F.lit(1)), "bits": F.bit_or(bit)}
    if layout.duration:
        counts["us"] = _total(layout.duration)
    words = _visits(tables, layout, date_from, date_to, tz).groupBy(PROFILE, word.alias("word"))
    words = words.agg(*(count.alias(name) for name, count in counts.items()))
    totals = [F.coalesce(F.sum(amount), F.lit(0)) for amount in (F.col("n"), F.bit_count("bits"))]
    totals = [total.alias(name) for total, name in zip(totals, layout.totals)]
    if layout.duration:
        totals.append(hours_2dp(F.sum("us").cast("decimal(38,0)")).alias("total_hours"))
    return words.groupBy(*owner(per_profile)).agg(*totals)


def domains(
    tables: Tables,
    browser: str,
    date_from: str | None = None,
    date_to: str | None = None,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Top domains by visits. Visits are counted per page first, so a hot page joins as one row."""
    layout = _layout(browser)
    per_page = _visits(tables, layout, date_from, date_to, tz).groupBy(PROFILE, "page").agg(F.count(F.lit(1)).alias("n"))
    counted = per_page.join(_domains_of(tables, layout), ["page", PROFILE]).groupBy(*owner(per_profile), "domain")
    order = [F.desc("cnt"), F.asc_nulls_first("domain")]
    return first_rows(counted.agg(F.sum("n").alias("cnt")), order, TOP_DOMAINS, per_profile)


def leading_domains(
    tables: Tables,
    browser: str,
    date_from: str | None = None,
    date_to: str | None = None,
    tz: str = "UTC",
    limit: int = TOP_DOMAINS,
) -> DataFrame:
    """``domains`` for very many different domains: those that cannot be among the first are never shuffled.

    Domains are hashed into SLOTS slots. No domain has more visits than its slot. The domains of the ``limit`` fullest
    slots give a bound: the last of their first ``limit`` is surely matched by the last of all. Only domains of slots
    that reach the bound are then counted one by one.
    """
    layout = _layout(browser)
    per_page = _visits(tables, layout, date_from, date_to, tz).groupBy(PROFILE, "page").agg(F.count(F.lit(1)).alias("n"))
    counted = per_page.join(_domains_of(tables, layout), ["page", PROFILE]).select("domain", "n")
    order = [F.desc("cnt"), F.asc_nulls_first("domain")]
    return first_rows(possible_domains(counted, limit), order, limit)


def possible_domains(counted: DataFrame, limit: int) -> DataFrame:
    """(domain, cnt): the sums of n over (domain, n) rows, of every domain that can be among the first ``limit`` and few
    others; ties with the last of them are there too."""
    counted = counted.withColumn("slot", F.pmod(F.xxhash64("domain"), F.lit(SLOTS)).cast("int"))
    slots = counted.groupBy("slot").agg(F.sum("n").alias("total"))
    fullest = first_rows(slots, [F.desc("total"), F.asc("slot")], limit).select("slot")
    # Broadcasts of at most SLOTS numbers.
    some = counted.join(F.broadcast(fullest), "slot", "left_semi").groupBy("domain").agg(F.sum("n").alias("cnt"))
    leaders = some.orderBy(F.desc("cnt")).limit(limit)
    bound = leaders.agg(F.when(F.count(F.lit(1)) == limit, F.min("cnt")).otherwise(F.lit(0))).scalar()
    reached = slots.where(F.col("total") >= bound).select("slot")
    return counted.join(F.broadcast(reached), "slot", "left_semi").groupBy("domain").agg(F.sum("n").alias("cnt"))


def types(
    tables: Tables,
    browser: str,
    date_from: str | None = None,
    date_to: str | None = None,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Visits per type label, most frequent first."""
    layout = _layout(browser)
    if layout.label is None:
        raise ValueError(f"{browser} has no visit types")
    labelled = _visits(tables, layout, date_from, date_to, tz).select(
        PROFILE, layout.label(F.col(layout.code)).alias("type")
    )
    counted = labelled.groupBy(*owner(per_profile), "type").agg(F.count(F.lit(1)).alias("cnt"))
    if per_profile:  # as many rows as profiles: too many for one task
        return first_rows(counted, [F.desc("cnt"), F.asc("type")], -1, per_profile)
    return in_order(counted, F.desc("cnt"), F.asc("type"))


def summary(
    tables: Tables, browser: str, date_from: str | None = None, date_to: str | None = None, tz: str = "UTC"
) -> DataFrame:
    """All sections in long form ``(section, rank, key, value)`` from one pass over the visits.

    Visits shrink to one row per page, then per domain, then per reported figure; no section
    scans the visits again. ``value`` is text because hours are not a count.
    """
    layout = _layout(browser)
    visits = _visits(tables, layout, date_from, date_to, tz)
    return report(page_counts(visits, layout), tables, browser)


def page_counts(visits: DataFrame, layout: Layout, *more: str) -> DataFrame:
    """(profile_id, *more, page, n, us, type_0...): visits, duration and visits of each type, as far as there are any."""
    counts = {"n": F.count(F.lit(1))}
    if layout.duration:
        counts["us"] = _total(layout.duration)
    if layout.label:
        visits = visits.withColumn("type", layout.label(F.col(layout.code)))
    for i, label in enumerate(layout.types):
        counts[f"type_{i}"] = F.count_if(F.col("type") == label)
    return visits.groupBy(PROFILE, *more, "page").agg(*(c.alias(name) for name, c in counts.items()))


def added_up(counts: DataFrame, layout: Layout, *more: str) -> DataFrame:
    """The same from rows of ``page_counts`` with the same keys in several parts."""
    sums = [F.sum(name).cast("decimal(38,0)" if name == "us" else "bigint").alias(name) for name in layout.counts]
    return counts.groupBy(PROFILE, *more, "page").agg(*sums)


def report(per_page: DataFrame, tables: Tables, browser: str) -> DataFrame:
    """The sections of ``summary`` from the counts of each page."""
    layout = _layout(browser)
    counts = layout.counts
    domains_of = _domains_of(tables, layout).withColumn("known", F.lit(True))
    per_domain = (
        per_page.join(domains_of, ["page", PROFILE], "left")
        .groupBy("known", "domain")
        .agg(F.count("page").alias("pages"), *(F.sum(name).alias(name) for name in counts))
    )

    def figure(section: str, key: Column | str, amount: Column) -> Column:
        key = F.lit(key) if isinstance(key, str) else key
        return F.struct(F.lit(section).alias("section"), key.alias("key"), amount.cast("decimal(38,0)").alias("amount"))

    totals = [figure(BASIC, "total_visits", F.col("n")), figure(BASIC, "unique_urls", F.col("pages"))]
    if layout.duration:
        totals.append(figure(BASIC, "total_hours", F.col("us")))
    labelled = [figure(TYPES, label, F.col(f"type_{i}")) for i, label in enumerate(layout.types)]
    top = F.when(F.col("known"), F.array(figure(DOMAINS, F.col("domain"), F.col("n")))).otherwise(F.array())
    figures = per_domain.select(F.explode(F.concat(F.array(*totals, *labelled), top)).alias("f")).select("f.*")

    # Without any visit the totals are still reported: 0, 0 and no hours.
    zero, none = F.lit(0), F.lit(None)
    seeds = [figure(BASIC, key, none if key == "total_hours" else zero) for key in layout.totals]
    seed_rows = per_page.sparkSession.range(1).select(F.explode(F.array(*seeds)).alias("f")).select("f.*")
    sums = figures.unionByName(seed_rows).groupBy("section", "key").agg(F.sum("amount").alias("amount"))
    return _ranked(sums, layout)


def _ranked(sums: DataFrame, layout: Layout) -> DataFrame:
    """Rank each section's figures; totals in their fixed order, the others by count.

    Of the domains ten are kept, of the other sections every figure. One cut that is as long as
    the longest of them is made in every partition first, so the many domains never meet in one task.
    """
    fixed = F.array_position(F.array(*(F.lit(key) for key in layout.totals)), F.col("key"))
    place = F.when(F.col("section") == BASIC, fixed)
    order = Window.partitionBy("section").orderBy(place, F.desc("amount"), F.asc_nulls_first("key"))
    is_hours = (F.col("section") == BASIC) & (F.col("key") == "total_hours")
    text = F.when(is_hours, real_text(hours_2dp(F.col("amount")))).otherwise(F.col("amount").cast("string"))
    longest = max(TOP_DOMAINS, len(layout.types), len(layout.totals))
    figures = (
        sums.where((F.col("section") != TYPES) | (F.col("amount") > 0))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= longest)
        .where((F.col("section") != DOMAINS) | (F.col("rank") <= TOP_DOMAINS))
        .select("section", "rank", "key", text.alias("value"))
    )
    return in_order(figures, F.asc("section"), F.asc("rank"))
