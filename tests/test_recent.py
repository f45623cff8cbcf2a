"""The hour cut must never lose a row of the first n."""

import random

import pytest
from rows import tuples

from pagetrail.functions.timecodec import CHROMIUM_TIME, FIREFOX_TIME, SAFARI_TIME
from pagetrail.operators import chromium
from pagetrail.plans.newest import first_rows, newest, recent
from pagetrail.schemas import CHROMIUM

HOUR = 3_600_000_000


def times(rng, spread):
    exact = [k * HOUR + d for k in range(-3, 4) for d in (-1, 0, 1)]
    return exact + [rng.randrange(-spread, spread) for _ in range(300)] + [None] * 5 + [2**63 - 1, -(2**63)]


@pytest.mark.parametrize("spread", [HOUR // 2, 50 * HOUR, 2**62])
@pytest.mark.parametrize("need", [1, 7, 100, 326, 5000])
def test_cut_keeps_the_first_rows(spark, spread, need):
    rng = random.Random(spread + need)
    rows = [("p", i, t) for i, t in enumerate(times(rng, spread))]
    frame = spark.createDataFrame(rows, "profile_id string, id bigint, t bigint")
    order = newest("t", "id")
    want = tuples(first_rows(frame, order, need))
    assert tuples(first_rows(recent(frame, "t", FIREFOX_TIME, need), order, need)) == want


@pytest.mark.parametrize("need", [3, 50])
def test_cut_on_real_seconds(spark, need):
    rng = random.Random(need)
    values = [rng.uniform(-9000, 9000) for _ in range(200)] + [1e300, -1e300, float("inf"), None, 0.0, 3600.0, -3600.0]
    frame = spark.createDataFrame([("p", i, v) for i, v in enumerate(values)], "profile_id string, id bigint, t double")
    order = newest("t", "id")
    cut = recent(frame, "t", SAFARI_TIME, need)
    assert tuples(first_rows(cut, order, need)) == tuples(first_rows(frame, order, need))


def test_cut_really_cuts(spark):
    frame = spark.range(10_000).selectExpr("'p' AS profile_id", "id", f"id * {HOUR // 4} AS t")
    assert 10 <= recent(frame, "t", FIREFOX_TIME, 10).count() <= 20


def test_downloads_with_unshowable_times(table):
    base = 13348540800000000
    rows = [("p", i, f"ok{i}", 1, "", 1, base + i * HOUR, "", "") for i in range(200)]
    rows += [("p", 1000 + i, "corrupt", 1, "", 1, 2**62 + i, "", "") for i in range(50)]
    frame = table(CHROMIUM, "downloads", rows)
    got = tuples(chromium.downloads({"downloads": frame}, limit=10, tz="America/New_York"))
    assert [r[0] for r in got] == [f"ok{i}" for i in range(199, 189, -1)]
    assert recent(frame, "start_time", CHROMIUM_TIME, 10).count() < 70
