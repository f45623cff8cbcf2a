"""Column layout of the landed history tables, one mapping per browser family.

Every landed table also carries a leading ``profile_id``: ids inside a history
database are unique only within that one profile, so every key in this package
is (profile_id, id).
"""

from __future__ import annotations

from pyspark.sql.types import StructType

PROFILE = "profile_id"

CHROMIUM = {
    "urls": "id bigint, url string, title string, visit_count bigint, typed_count bigint, last_visit_time bigint",
    "visits": "id bigint, url bigint, visit_time bigint, from_visit bigint, transition bigint, visit_duration bigint",
    "keyword_search_terms": "term string, url_id bigint",
    "downloads": "id bigint, target_path string, total_bytes bigint, mime_type string, state bigint, "
    "start_time bigint, tab_url string, referrer string",
    "content_annotations": "visit_id bigint, categories string, page_language string, search_terms string",
    "context_annotations": "visit_id bigint, total_foreground_duration bigint, response_code bigint, "
    "tab_id bigint, window_id bigint",
}

FIREFOX = {
    "moz_places": "id bigint, url string, title string, visit_count bigint, last_visit_date bigint",
    "moz_historyvisits": "id bigint, from_visit bigint, place_id bigint, visit_date bigint, visit_type bigint",
    "moz_inputhistory": "place_id bigint, input string, use_count double",
    "moz_bookmarks": "id bigint, type bigint, fk bigint, parent bigint, title string, dateAdded bigint",
}

SAFARI = {
    "history_items": "id bigint, url string, visit_count bigint, visit_count_score double",
    "history_visits": "id bigint, history_item bigint, visit_time double, title string, "
    "redirect_source bigint, redirect_destination bigint",
}

#: browsers of the Chromium schema
CHROMIUM_BROWSERS = ("chrome", "edge", "brave", "vivaldi", "opera")

#: browser name -> tables its history database holds
FAMILIES = {**dict.fromkeys(CHROMIUM_BROWSERS, CHROMIUM), "firefox": FIREFOX, "safari": SAFARI}

#: table -> the column that dates its rows, if any does
TIME_COLUMNS = {
    "urls": "last_visit_time",
    "visits": "visit_time",
    "downloads": "start_time",
    "moz_places": "last_visit_date",
    "moz_historyvisits": "visit_date",
    "moz_bookmarks": "dateAdded",
    "history_items": "visit_count_score",
    "history_visits": "visit_time",
}

#: raw saved-tab storage files
SAVED_TAB_FILES = f"{PROFILE} string, file_name string, content binary"


def table_schema(family: dict[str, str], table: str) -> StructType:
    """Schema of one landed table, profile column first."""
    return StructType.fromDDL(f"{PROFILE} string, {family[table]}")
