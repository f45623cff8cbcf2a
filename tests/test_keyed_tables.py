"""Tables kept in buckets: the same reports, without a shuffle below the final sort."""

import pytest
from rows import tuples

from pagetrail.operators import chromium, firefox, safari
from pagetrail.schemas import CHROMIUM
from pagetrail.sources import keyed_tables
from workload import fixtures

SF = "/root/testdata/sf0.001"
MODULES = {"chrome": (chromium, fixtures.chromium), "firefox": (firefox, fixtures.firefox), "safari": (safari, fixtures.safari)}


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keyed"))
    for browser, (_, make) in MODULES.items():
        keyed_tables.keep_keyed(make(spark, SF), browser, path, buckets=5, rows_per_salt=10)
    return path


def reports(browser):
    module = MODULES[browser][0]
    names = {"chrome": "visits searches annotations contexts", "firefox": "visits searches", "safari": "visits"}[browser]
    return [getattr(module, name) for name in names.split()]


@pytest.mark.parametrize("browser", MODULES)
@pytest.mark.parametrize("options", [{"limit": -1}, {"limit": 20}, {"limit": 7, "per_profile": True}])
def test_same_rows(spark, kept, browser, options):
    tables = keyed_tables.keyed_tables(spark, kept, browser)
    plain = MODULES[browser][1](spark, SF)
    for report in reports(browser):
        assert tuples(report(tables, **options)) == tuples(report(plain, **options))


@pytest.mark.parametrize("browser", MODULES)
def test_dates(spark, kept, browser):
    module, make = MODULES[browser]
    tables = keyed_tables.keyed_tables(spark, kept, browser)
    options = {"date_from": "2024-01-05", "date_to": "2024-01-09", "limit": -1, "tz": "America/New_York"}
    assert tuples(module.visits(tables, **options)) == tuples(module.visits(make(spark, SF), **options))
    assert tuples(module.urls(tables, limit=-1)) == tuples(module.urls(make(spark, SF), limit=-1))


def exchanges(frame):
    """The exchanges of a plan, without that of the final sort."""
    lines = frame._jdf.queryExecution().executedPlan().toString().split("\n")
    return [line for line in lines if "Exchange" in line and "rangepartitioning" not in line]


@pytest.mark.parametrize("browser", MODULES)
def test_no_exchange_below_the_sort(spark, kept, browser):
    """Even where no table is small enough to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = keyed_tables.keyed_tables(spark, kept, browser)
        for report in reports(browser):
            frame = report(tables, limit=-1)
            frame.collect()
            assert exchanges(frame) == [], report
            assert "SortMergeJoin" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_page_is_spread(spark, table, tmp_path):
    """A third of all visits is to one page and a third to none; no bucket holds more than a share of them."""
    pages = table(CHROMIUM, "urls", [("p", i, f"https://{i}/", "t", 1, 1, i) for i in range(1, 40)])
    visits = spark.range(6000).selectExpr(
        "'p' AS profile_id", "id + 1 AS id", "CASE id % 3 WHEN 0 THEN id % 45 WHEN 1 THEN 7 END AS url", "13348540800000000 + id AS visit_time",
        "if(id % 4 = 0, NULL, id) AS from_visit", "1L AS transition", "id AS visit_duration",
    )
    empty = {name: table(CHROMIUM, name, []) for name in CHROMIUM}
    tables = {**empty, "urls": pages, "visits": visits}
    keyed_tables.keep_keyed(tables, "chrome", str(tmp_path), buckets=8, rows_per_salt=100)
    got = keyed_tables.keyed_tables(spark, str(tmp_path), "chrome")
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/chrome/visits").groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 1500
    assert tuples(chromium.visits(got, limit=-1)) == tuples(chromium.visits(tables, limit=-1))
    assert got["urls"].count() == 39


def test_kept_again_and_read_by_another_session(spark, kept, tmp_path, table):
    empty = {name: table(CHROMIUM, name, []) for name in CHROMIUM}
    keyed_tables.keep_keyed(fixtures.chromium(spark, SF), "chrome", str(tmp_path), buckets=3)
    keyed_tables.keep_keyed(empty, "chrome", str(tmp_path), buckets=2)
    assert chromium.visits(keyed_tables.keyed_tables(spark, str(tmp_path), "chrome"), limit=-1).collect() == []
    for name in spark.catalog.listTables():  # as if nothing were known of the folder
        if name.name.startswith("keyed_"):
            spark.sql(f"DROP TABLE {name.name}")
    tables = keyed_tables.keyed_tables(spark, kept, "chrome")
    frame = chromium.visits(tables, limit=-1)
    assert frame.count() > 0
    with pytest.raises(ValueError):
        keyed_tables.keyed_tables(spark, kept, "netscape")
