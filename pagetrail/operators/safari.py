"""Reports over Safari tables (the names of ``schemas.SAFARI``).

With ``per_profile`` the limit is one for each profile, and ``profile_id`` the first column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.scalars import blank_if_null
from pagetrail.functions.timecodec import SAFARI_TIME, in_dates, local_text
from pagetrail.plans.newest import (
    attach,
    fetch,
    first_rows,
    ids_of,
    is_cut,
    join_links,
    keep,
    leading,
    leading_matched,
    merged_first_rows,
    newest,
    newest_matched,
    owner,
    page_names,
    page_of_visit,
    referrer_urls,
)
from pagetrail.schemas import PROFILE

Tables = Mapping[str, DataFrame]

LAST_VISIT_SOURCES = ("score", "max_visit_time")


def _latest_titles(visits: DataFrame) -> DataFrame:
    """Each page's newest non-empty visit title, reduced map-side before the shuffle."""
    titled = visits.where(F.col("title").isNotNull() & (F.col("title") != ""))
    latest = F.max_by("title", F.struct("visit_time", "id"))
    return titled.groupBy(PROFILE, F.col("history_item").alias("id")).agg(latest.alias("title"))


def urls(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    last_visit: str = "score",
    per_profile: bool = False,
) -> DataFrame:
    """Visited pages that have a visit in the date range, with their latest title.

    ``last_visit="score"`` orders by and shows ``visit_count_score`` read as a time;
    ``"max_visit_time"`` uses the newest visit instead.
    """
    if last_visit not in LAST_VISIT_SOURCES:
        raise ValueError(f"last_visit must be one of {LAST_VISIT_SOURCES}, got {last_visit!r}")
    visits = tables["history_visits"]
    pages = tables["history_items"].where(F.col("visit_count") > 0)
    in_range = in_dates(F.col("visit_time"), SAFARI_TIME, date_from, date_to, tz)
    if in_range is not None:
        seen = visits.where(in_range).select(PROFILE, F.col("history_item").alias("id")).distinct()
        pages = pages.join(seen, ["id", PROFILE], "left_semi")
    if last_visit == "score":
        pages = pages.withColumnRenamed("visit_count_score", "last_visit")
    else:
        newest_visit = visits.groupBy(PROFILE, F.col("history_item").alias("id")).agg(
            F.max("visit_time").alias("last_visit")
        )
        pages = pages.join(newest_visit, ["id", PROFILE], "left")
    order = newest("last_visit", "id")
    if is_cut(limit, per_profile):
        pages = merged_first_rows(pages, order, limit)
        visits = fetch(visits, pages.select(PROFILE, F.col("id").alias("history_item")), "history_item", limit)
    elif per_profile:
        pages, limit = leading(pages, order, limit), -1
    rows = pages.join(_latest_titles(visits), ["id", PROFILE], "left")
    return first_rows(rows, order, limit, per_profile).select(
        *owner(per_profile),
        "url",
        blank_if_null(F.col("title")).alias("title"),
        "visit_count",
        local_text(F.col("last_visit"), SAFARI_TIME, tz).alias("last_visit_time"),
    )


def visits(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Single visits, newest first, with the pages they were redirected from and to."""
    pages = tables["history_items"]
    every = tables["history_visits"]
    dated = keep(every, in_dates(F.col("visit_time"), SAFARI_TIME, date_from, date_to, tz))
    order = newest("visit_time", "history_item", "id")
    links = ("redirect_source", "redirect_destination")
    if is_cut(limit, per_profile):
        matches = [(ids_of(pages, "history_item"), "history_item")]
        top = newest_matched(dated.drop("title"), matches, order, limit, "visit_time", SAFARI_TIME)
        rows = attach(top, pages, "history_item", {"url": "url"}, limit)
        rows = rows.join(fetch(every.select(PROFILE, "id", "title"), top, "id", limit), ["id", PROFILE])
        # Both ends in one pass over visits and pages; the two joins share its result.
        ends = top.select(PROFILE, F.explode(F.array(*links)).alias("end"))
        targets = referrer_urls(ends, every, pages, "end", "history_item", 2 * limit)
        for link in links:
            urls = targets.select(PROFILE, F.col("end").alias(link), F.col("_url").alias(f"{link}_url"))
            rows = rows.join(urls, [link, PROFILE], "left")
    elif "named_history_visits" in tables:
        rows = tables["named_history_visits"].withColumnRenamed("page", "history_item")
        rows = keep(rows, in_dates(F.col("visit_time"), SAFARI_TIME, date_from, date_to, tz))
        rows, limit = (leading(rows, order, limit), -1) if per_profile else (rows, limit)
    else:
        if per_profile:
            dated, limit = leading_matched(dated, ids_of(pages, "history_item"), "history_item", order, limit), -1
        rows = dated.join(page_names(pages, "history_item", "url"), ["history_item", PROFILE])
        targets = page_of_visit(every, pages, "history_item")
        for link in links:
            rows = join_links(rows, targets, link, f"{link}_url")
    return first_rows(rows, order, limit, per_profile).select(
        *owner(per_profile),
        "url",
        blank_if_null(F.col("title")).alias("title"),
        local_text(F.col("visit_time"), SAFARI_TIME, tz).alias("visit_time"),
        *(blank_if_null(F.col(f"{link}_url")).alias(link) for link in links),
    )
