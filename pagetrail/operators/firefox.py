"""Reports over Firefox tables (the names of ``schemas.FIREFOX``).

With ``per_profile`` the limit is one for each profile, and ``profile_id`` the first column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.labels import firefox_visit_type
from pagetrail.functions.scalars import blank_if_null
from pagetrail.functions.timecodec import FIREFOX_TIME, in_dates, local_text
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
    newest,
    newest_matched,
    owner,
    page_names,
    page_of_visit,
    recent,
    referrer_urls,
)
from pagetrail.schemas import PROFILE

Tables = Mapping[str, DataFrame]

BOOKMARK_TYPE = 1


def urls(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Visited pages by last visit; pages without a date come last, and only without bounds."""
    pages = tables["moz_places"].where(F.col("visit_count") > 0)
    pages = keep(pages, in_dates(F.col("last_visit_date"), FIREFOX_TIME, date_from, date_to, tz))
    if is_cut(limit, per_profile):
        pages = recent(pages, "last_visit_date", FIREFOX_TIME, limit)
    return first_rows(pages, newest("last_visit_date", "id"), limit, per_profile).select(
        *owner(per_profile),
        "url",
        blank_if_null(F.col("title")).alias("title"),
        "visit_count",
        local_text(F.col("last_visit_date"), FIREFOX_TIME, tz).alias("last_visit_time"),
    )


def visits(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Single visits, newest first, with visit type and the referring page."""
    pages = tables["moz_places"]
    every = tables["moz_historyvisits"]
    dated = keep(every, in_dates(F.col("visit_date"), FIREFOX_TIME, date_from, date_to, tz))
    order = newest("visit_date", "place_id", "id")
    if is_cut(limit, per_profile):
        matches = [(ids_of(pages, "place_id"), "place_id")]
        top = newest_matched(dated, matches, order, limit, "visit_date", FIREFOX_TIME)
        named = attach(top, pages, "place_id", {"url": "url", "title": "title"}, limit)
        from_urls = referrer_urls(top, every, pages, "from_visit", "place_id", limit).withColumnRenamed("_url", "from_url")
        rows = named.join(from_urls, ["from_visit", PROFILE], "left")
    elif "named_moz_historyvisits" in tables:
        rows = tables["named_moz_historyvisits"].withColumnsRenamed({"page": "place_id", "from_visit_url": "from_url"})
        rows = keep(rows, in_dates(F.col("visit_date"), FIREFOX_TIME, date_from, date_to, tz))
        rows, limit = (leading(rows, order, limit), -1) if per_profile else (rows, limit)
    else:
        if per_profile:
            dated, limit = leading_matched(dated, ids_of(pages, "place_id"), "place_id", order, limit), -1
        named = dated.join(page_names(pages, "place_id", "url", "title"), ["place_id", PROFILE])
        rows = join_links(named, page_of_visit(every, pages, "place_id"), "from_visit", "from_url")
    return first_rows(rows, order, limit, per_profile).select(
        *owner(per_profile),
        "url",
        blank_if_null(F.col("title")).alias("title"),
        local_text(F.col("visit_date"), FIREFOX_TIME, tz).alias("visit_time"),
        firefox_visit_type(F.col("visit_type")).alias("transition"),
        blank_if_null(F.col("from_url")).alias("from_url"),
    )


def searches(tables: Tables, limit: int = 100, per_profile: bool = False) -> DataFrame:
    """Address-bar inputs by use count. They carry no date, so there is no date range."""
    inputs = tables["moz_inputhistory"]
    pages = tables["moz_places"]
    names = page_names(pages, "place_id", "url", "title")
    order = newest("use_count", "place_id", "input")
    if is_cut(limit, per_profile):
        # The first n (use_count, page) pairs name every page the first n inputs can belong to.
        matches = [(ids_of(pages, "place_id"), "place_id")]
        pairs = inputs.select(PROFILE, "place_id", "use_count")
        top = newest_matched(pairs, matches, newest("use_count", "place_id"), limit)
        rows = first_rows(fetch(inputs, top, "place_id", limit), order, limit)
        rows = rows.join(fetch(names, top, "place_id", limit), ["place_id", PROFILE])
    elif "named_moz_inputhistory" in tables:
        rows = tables["named_moz_inputhistory"].withColumnRenamed("page", "place_id")
    else:
        rows = inputs.join(names, ["place_id", PROFILE])
    return first_rows(rows, order, limit, per_profile).select(
        *owner(per_profile),
        "input", "url", blank_if_null(F.col("title")).alias("title"), "use_count"
    )


def bookmarks(tables: Tables, limit: int = 100, tz: str = "UTC", per_profile: bool = False) -> DataFrame:
    """Bookmarks by date added with page URL and folder title; folders and separators are left out."""
    every = tables["moz_bookmarks"]
    marks = every.where(F.col("type") == BOOKMARK_TYPE).drop("type")
    order = newest("dateAdded", "id")
    places = page_names(tables["moz_places"], "fk", "url")
    folders = every.select(PROFILE, F.col("id").alias("parent"), F.col("title").alias("parent_title"))
    if is_cut(limit, per_profile):
        marks = first_rows(recent(marks, "dateAdded", FIREFOX_TIME, limit), order, limit)
        places = fetch(places, marks, "fk", limit)
        folders = fetch(folders, marks, "parent", limit)
    elif per_profile:
        marks, limit = leading(marks, order, limit), -1
    rows = marks.join(places, ["fk", PROFILE], "left").join(folders, ["parent", PROFILE], "left")
    return first_rows(rows, order, limit, per_profile).select(
        *owner(per_profile),
        "title",
        blank_if_null(F.col("url")).alias("url"),
        local_text(F.col("dateAdded"), FIREFOX_TIME, tz).alias("dateAdded"),
        blank_if_null(F.col("parent_title")).alias("parent_title"),
    )
