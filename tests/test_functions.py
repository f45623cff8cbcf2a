import os
import sqlite3
import time

import pytest
from pyspark.sql import functions as F

from pagetrail.functions import labels, scalars
from pagetrail.functions.timecodec import (
    CHROMIUM_TIME,
    FIREFOX_TIME,
    SAFARI_TIME,
    date_bounds,
    in_dates,
    local_text,
    midnight,
)

NEW_YORK = "America/New_York"


def column(spark, values, kind, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("x"))).collect()]


@pytest.fixture
def sqlite_text():
    """SQLite's own rendering of Unix seconds in New York."""
    before = os.environ.get("TZ")
    os.environ["TZ"] = NEW_YORK
    time.tzset()
    db = sqlite3.connect(":memory:")
    yield lambda sql, values: [db.execute(f"SELECT {sql}", (v,)).fetchone()[0] for v in values]
    if before is None:
        del os.environ["TZ"]
    else:
        os.environ["TZ"] = before
    time.tzset()


SECONDS = [0, 1704067200, 1704067199, 1710054000, 1710053999, 1730610000, 1730613599, 1730613600, -1, -86400 * 400,
           2147385600, 2147385601, 2524608000, -11644473600, 4102444800]


def test_chromium_text_matches_sqlite(spark, sqlite_text):
    raws = [(s + 11644473600) * 1_000_000 + f for s in SECONDS for f in (0, 1, 999_999)] + [0, 5]
    want = sqlite_text("datetime(?/1000000 - 11644473600, 'unixepoch', 'localtime')", raws)
    assert column(spark, raws, "bigint", lambda c: local_text(c, CHROMIUM_TIME, NEW_YORK)) == want


def test_firefox_text_matches_sqlite(spark, sqlite_text):
    raws = [s * 1_000_000 + f for s in SECONDS for f in (0, 1, 999_999)]
    want = sqlite_text("datetime(?/1000000, 'unixepoch', 'localtime')", raws)
    assert column(spark, raws, "bigint", lambda c: local_text(c, FIREFOX_TIME, NEW_YORK)) == want


def test_safari_text_matches_sqlite(spark, sqlite_text):
    raws = [s - 978307200 + f for s in SECONDS for f in (0.0, 0.25, 0.9994, 0.9995, 0.9996, 0.99999)]
    want = sqlite_text("datetime(? + 978307200, 'unixepoch', 'localtime')", raws)
    assert column(spark, raws, "double", lambda c: local_text(c, SAFARI_TIME, NEW_YORK)) == want


def test_text_in_utc_and_out_of_range(spark):
    shown = column(
        spark, [0, None, -(2**63), 2**63 - 1, 13348540800000000], "bigint", lambda c: local_text(c, CHROMIUM_TIME, "UTC")
    )
    assert shown == ["1601-01-01 00:00:00", None, None, None, "2024-01-01 00:00:00"]
    shown = column(spark, [1e300, -1e300, float("nan")], "double", lambda c: local_text(c, SAFARI_TIME, NEW_YORK))
    assert shown[:2] == [None, None]


def test_date_bounds():
    assert date_bounds(FIREFOX_TIME, "2024-01-01", None, "UTC") == (1704067200 * 10**6, None)
    assert date_bounds(CHROMIUM_TIME, None, "2024-01-01", "UTC") == (None, (1704067200 + 86400 + 11644473600) * 10**6)
    assert date_bounds(SAFARI_TIME, "2001-01-01", "2001-01-01", "UTC") == (0, 86400)
    # The end of a 23-hour day is still 24 hours after its midnight.
    low, high = date_bounds(FIREFOX_TIME, "2024-03-10", "2024-03-10", NEW_YORK)
    assert low == 1710046800 * 10**6 and high - low == 86400 * 10**6


@pytest.mark.parametrize("bad", ["", "2024-1-1", "2024-02-30", "yesterday", "2024-01-01 ", "20240101", 20240101])
def test_bad_dates_are_errors(bad):
    with pytest.raises(ValueError):
        midnight(bad, "UTC")


def test_range_is_inclusive_of_both_days(spark):
    low, high = date_bounds(FIREFOX_TIME, "2024-01-05", "2024-01-06", NEW_YORK)
    frame = spark.createDataFrame([(v,) for v in (low - 1, low, high - 1, high, None)], "t bigint")
    kept = frame.where(in_dates(F.col("t"), FIREFOX_TIME, "2024-01-05", "2024-01-06", NEW_YORK)).collect()
    assert sorted(r.t for r in kept) == [low, high - 1]
    assert in_dates(F.col("t"), FIREFOX_TIME, None, None, "UTC") is None


DOMAINS = {
    "https://www.a.com/x/y": "a.com",
    "https://a.com": "",
    "https://a.com?q=1/2": "a.com?q=1",
    "https://www.awww.com/": "acom",
    "https://WWW.A.com/": "WWW.A.com",
    "http://u@h:80/": "u@h:80",
    "file:///home/x": "",
    "about:blank": "",
    "data:text/html": "ta:text",
    "": "",
    "http://www.www.b/c/c": "b",
    "x://a/b/a/b": "a",
    None: None,
}


def test_domain(spark):
    assert column(spark, list(DOMAINS), "string", scalars.domain) == list(DOMAINS.values())


def test_transition_labels(spark):
    codes = [*range(11), 11, 255, -1, 805306368 + 7, 805306368 + 12, None]
    got = column(spark, codes, "bigint", labels.chromium_transition)
    names = ["LINK", "TYPED", "BOOKMARK", "AUTO_SUBFRAME", "MANUAL_SUBFRAME", "GENERATED", "AUTO_TOPLEVEL"]
    names += ["FORM_SUBMIT", "RELOAD", "KEYWORD", "KEYWORD_GENERATED"]
    assert got == [*names, "OTHER(11)", "OTHER(255)", "OTHER(255)", "FORM_SUBMIT", "OTHER(12)", None]
    coarse = column(spark, codes, "bigint", labels.chromium_transition_group)
    assert coarse[:3] == ["LINK", "TYPED", "BOOKMARK"] and coarse[7:10] == ["FORM_SUBMIT", "RELOAD", "KEYWORD"]
    assert set(coarse[3:7] + coarse[10:14] + coarse[-2:]) == {"OTHER"}


def test_state_and_visit_type_labels(spark):
    got = column(spark, [0, 1, 2, 3, 4, -1, None], "bigint", labels.download_state)
    assert got == ["IN_PROGRESS", "COMPLETE", "CANCELLED", "INTERRUPTED", "UNKNOWN(4)", "UNKNOWN(-1)", None]
    got = column(spark, [0, 1, 5, 6, 9, 10, None], "bigint", labels.firefox_visit_type)
    assert got == ["OTHER(0)", "LINK", "REDIRECT_PERM", "REDIRECT_TEMP", "RELOAD", "OTHER(10)", None]
    got = column(spark, [0, 4, 7, 8, None], "bigint", labels.firefox_visit_type_group)
    assert got == ["OTHER", "EMBED", "DOWNLOAD", "FRAMED_LINK", "OTHER"]


def test_exact_rounding(spark):
    got = column(spark, [6_550_000, -1_000_000, 49_999, 50_000, -50_000, 0, None], "bigint", scalars.seconds_1dp)
    assert got == [6.6, -1.0, 0.0, 0.1, -0.1, 0.0, None]
    got = column(spark, [18_000_000, 17_999_999, 3_600_000_000, -18_000_000, None], "bigint", scalars.hours_2dp)
    assert got == [0.01, 0.0, 1.0, -0.01, None]
    assert column(spark, [2**63 - 1], "bigint", scalars.seconds_1dp) == [None]


def test_real_text(spark):
    values = [0.0, 6.6, 10.0, 12345678.9, 0.1 + 0.2, 0.975**3, -2.5, 1e14, 0.0001, None]
    got = column(spark, values, "double", scalars.real_text)
    assert got == ["0.0", "6.6", "10.0", "12345678.9", "0.3", "0.926859375", "-2.5", "100000000000000.0", "0.0001", None]
