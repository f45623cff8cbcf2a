"""Reports over Chromium-family tables (Chrome, Edge and other browsers of that schema).

``tables`` maps the table names of ``schemas.CHROMIUM`` to DataFrames. Dates are
inclusive ``YYYY-MM-DD`` strings in ``tz``; a negative ``limit`` keeps every row. With
``per_profile`` the limit is one for each profile, and ``profile_id`` the first column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.labels import chromium_transition, download_state
from pagetrail.functions.scalars import blank_if_null, seconds_1dp
from pagetrail.functions.timecodec import CHROMIUM_TIME, in_dates, local_text, local_time
from pagetrail.plans.newest import (
    attach,
    fetch,
    few,
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


def _dated(df: DataFrame, column: str, date_from: str | None, date_to: str | None, tz: str) -> DataFrame:
    return keep(df, in_dates(F.col(column), CHROMIUM_TIME, date_from, date_to, tz))


def _time(column: str, tz: str, name: str | None = None):
    return local_text(F.col(column), CHROMIUM_TIME, tz).alias(name or column)


def urls(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Pages by last visit."""
    pages = _dated(tables["urls"], "last_visit_time", date_from, date_to, tz)
    if is_cut(limit, per_profile):
        pages = recent(pages, "last_visit_time", CHROMIUM_TIME, limit)
    return first_rows(pages, newest("last_visit_time", "id"), limit, per_profile).select(
        *owner(per_profile), "url", "title", "visit_count", "typed_count", _time("last_visit_time", tz)
    )


def visits(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Single visits, newest first, with transition label, duration and the referring page."""
    pages = tables["urls"]
    every = tables["visits"].withColumnRenamed("url", "page")
    dated = _dated(every, "visit_time", date_from, date_to, tz)
    order = newest("visit_time", "page", "id")
    if is_cut(limit, per_profile):
        top = newest_matched(dated, [(ids_of(pages, "page"), "page")], order, limit, "visit_time", CHROMIUM_TIME)
        named = attach(top, pages, "page", {"url": "url", "title": "title"}, limit)
        from_urls = referrer_urls(top, every, pages, "from_visit", "page", limit).withColumnRenamed("_url", "from_url")
        rows = named.join(from_urls, ["from_visit", PROFILE], "left")
    elif "named_visits" in tables:
        rows = _dated(tables["named_visits"], "visit_time", date_from, date_to, tz)
        rows, limit = (leading(rows, order, limit), -1) if per_profile else (rows, limit)
        rows = rows.withColumnRenamed("from_visit_url", "from_url")
    else:
        if per_profile:
            dated, limit = leading_matched(dated, ids_of(pages, "page"), "page", order, limit), -1
        named = dated.join(page_names(pages, "page", "url", "title"), ["page", PROFILE])
        rows = join_links(named, page_of_visit(every, pages, "page"), "from_visit", "from_url")
    return first_rows(rows, order, limit, per_profile).select(
        *owner(per_profile),
        "url",
        "title",
        _time("visit_time", tz),
        seconds_1dp(F.col("visit_duration")).alias("duration_sec"),
        chromium_transition(F.col("transition")).alias("transition"),
        blank_if_null(F.col("from_url")).alias("from_url"),
    )


def searches(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Search terms by the last visit of their result page (a term itself has no time)."""
    terms = tables["keyword_search_terms"]
    pages = _dated(tables["urls"], "last_visit_time", date_from, date_to, tz).withColumnRenamed("id", "url_id")
    order = newest("last_visit_time", "url_id", "term")
    if is_cut(limit, per_profile):
        # Every page kept here has a term, so the first n pages hold the first n rows.
        timed = pages.select(PROFILE, "url_id", "last_visit_time")
        used = [(terms.select(PROFILE, "url_id"), "url_id")]
        by_page = newest("last_visit_time", "url_id")
        leaders = newest_matched(timed, used, by_page, limit, "last_visit_time", CHROMIUM_TIME, repeating=["url_id"])
        top = first_rows(terms.join(few(leaders, limit), ["url_id", PROFILE]), order, limit)
        names = fetch(pages.select(PROFILE, "url_id", "url", "title"), top, "url_id", limit)
        rows = top.join(names, ["url_id", PROFILE])
    elif "named_keyword_search_terms" in tables:
        rows = _dated(tables["named_keyword_search_terms"], "last_visit_time", date_from, date_to, tz)
        rows = rows.withColumnRenamed("page", "url_id")
    else:
        rows = terms.join(pages, ["url_id", PROFILE])
    rows = first_rows(rows, order, limit, per_profile)
    return rows.select(*owner(per_profile), "term", "url", "title", _time("last_visit_time", tz))


def downloads(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Downloads by *displayed* start time: local wall-clock seconds, then the raw time."""
    rows = _dated(tables["downloads"], "start_time", date_from, date_to, tz)
    shown = local_time(CHROMIUM_TIME.unix_seconds(F.col("start_time")), tz)
    # Zone offsets differ by less than 36 hours, so no earlier download is shown later than that.
    showable = F.when(shown.isNotNull(), F.col("start_time"))
    if is_cut(limit, per_profile):
        rows = recent(rows, "start_time", CHROMIUM_TIME, limit, slack_hours=36, counted=showable)
    top = first_rows(rows, [shown.desc_nulls_last(), *newest("start_time", "id")], limit, per_profile)
    return top.select(
        *owner(per_profile),
        "target_path",
        "total_bytes",
        "mime_type",
        download_state(F.col("state")).alias("state"),
        _time("start_time", tz),
        blank_if_null(F.col("tab_url")).alias("tab_url"),
        blank_if_null(F.col("referrer")).alias("referrer"),
    )


def _annotated(
    tables: Tables, table: str, date_from: str | None, date_to: str | None, limit: int, tz: str, per_profile: bool
) -> DataFrame:
    """Annotation rows with their visit's time and page, newest first."""
    pages, notes = tables["urls"], tables[table]
    timed = _dated(tables["visits"], "visit_time", date_from, date_to, tz).select(
        PROFILE, F.col("id").alias("visit_id"), F.col("url").alias("page"), "visit_time"
    )
    names = page_names(pages, "page", "url", "title")
    order = newest("visit_time", "page", "visit_id")
    if is_cut(limit, per_profile):
        matches = [(ids_of(notes, "visit_id", "visit_id"), "visit_id"), (ids_of(pages, "page"), "page")]
        top = newest_matched(timed, matches, order, limit, "visit_time", CHROMIUM_TIME, repeating=["visit_id"])
        rows = top.join(fetch(notes, top, "visit_id", limit), ["visit_id", PROFILE])
        rows = rows.join(fetch(names, top, "page", limit), ["page", PROFILE])
    elif f"named_{table}" in tables:
        rows = _dated(tables[f"named_{table}"], "visit_time", date_from, date_to, tz)
        rows, limit = (leading(rows, order, limit), -1) if per_profile else (rows, limit)
    else:
        rows = timed.join(notes, ["visit_id", PROFILE])
        if per_profile:
            rows, limit = leading_matched(rows, ids_of(pages, "page"), "page", order, limit), -1
        rows = rows.join(names, ["page", PROFILE])
    return first_rows(rows, order, limit, per_profile)


def annotations(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Page categories, language and search terms per visit."""
    rows = _annotated(tables, "content_annotations", date_from, date_to, limit, tz, per_profile)
    texts = (blank_if_null(F.col(c)).alias(c) for c in ("categories", "page_language", "search_terms"))
    return rows.select(*owner(per_profile), "url", "title", _time("visit_time", tz), *texts)


def contexts(
    tables: Tables,
    date_from: str | None = None,
    date_to: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
    per_profile: bool = False,
) -> DataFrame:
    """Foreground time, response code, tab and window per visit."""
    rows = _annotated(tables, "context_annotations", date_from, date_to, limit, tz, per_profile)
    return rows.select(
        *owner(per_profile),
        "url",
        "title",
        _time("visit_time", tz),
        seconds_1dp(F.col("total_foreground_duration")).alias("foreground_sec"),
        "response_code",
        "tab_id",
        "window_id",
    )
