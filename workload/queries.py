"""The registered queries: every report over tables derived from ``events`` and ``pages``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.operators import chromium, firefox, rollup, safari, saved_tabs, summary
from pagetrail.plans.kept import shared_folder
from pagetrail.sinks import text
from pagetrail.sources import clustered_tables, history_files, keyed_tables, profiles, snapshots
from workload import fixtures, oracle

Query = Callable[[SparkSession, str], DataFrame]

WEEK = {"date_from": "2024-01-08", "date_to": "2024-01-14"}
SINCE = {"date_from": "2024-01-20"}
UNTIL = {"date_to": "2024-01-12"}
EMPTY = {"date_from": "1999-01-01", "date_to": "1999-01-02"}
NEW_YORK = "America/New_York"
EVERY = {"limit": -1}

TABLES = {
    "chrome": fixtures.chromium,
    "edge": fixtures.edge,
    "firefox": fixtures.firefox,
    "safari": fixtures.safari,
}
WRAP = {"chrome": oracle.chromium, "edge": oracle.edge, "firefox": oracle.firefox, "safari": oracle.safari}


def _report(browser: str, operator: Callable, sql: Callable, sql_options: dict | None = None, **options):
    """A report query and its oracle, called with the same options."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(TABLES[browser](spark, sf_dir), **options)

    return run, WRAP[browser](sql(**(options if sql_options is None else sql_options)))


def _section(browser: str, operator: Callable, sql: Callable, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(TABLES[browser](spark, sf_dir), browser, **options)

    return run, sql(browser, **options)


def _summary_text(browser: str, **dates):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        figures = summary.summary(TABLES[browser](spark, sf_dir), browser, **dates)
        return text.summary_lines(figures, browser, **dates)

    return run, oracle.summary_text(browser, **dates)


def _lines(browser: str, operator: Callable, sql: Callable, columns: str, fmt: str, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return text.with_header(operator(TABLES[browser](spark, sf_dir), **options), fmt)

    separator = {"tsv": "\t", "csv": ","}[fmt]
    return run, oracle.lines(WRAP[browser], sql(**options), columns.split(), separator)


def _tabs(grouped: bool, limit: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return saved_tabs.saved_tabs(fixtures.saved_tab_files(spark, sf_dir, grouped), limit)

    return run, oracle.saved_tabs(grouped, limit)


def _profiles(browser: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return profiles.select_profiles(fixtures.profile_listing(spark, sf_dir, browser), browser)

    return run, oracle.profile_select(browser)


def _ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_files.history_rows(fixtures.sqlite_files(spark, sf_dir), "chrome")


def _ingested_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_files.tables_from(_ingest(spark, sf_dir), "chrome")["visits"]


def _rejected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_files.rejected(_ingest(spark, sf_dir)).select("profile_id")


def _visit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.visit_pairs(chromium.visits(fixtures.chromium(spark, sf_dir)))


def _visit_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.visit_count_lines(firefox.urls(fixtures.firefox(spark, sf_dir)))


def _fleet(operator: Callable, sql: str, *args, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(fixtures.chromium_fleet(spark, sf_dir), *args, **options)

    return run, sql


def _keyed(browser: str, operator: Callable, sql: str):
    """An unlimited report over tables kept in buckets, in a folder of this run."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_folder(spark)}/keyed-{uuid.uuid4()}"
        keyed_tables.keep_keyed(TABLES[browser](spark, sf_dir), browser, path, buckets=8, rows_per_salt=500)
        return operator(keyed_tables.keyed_tables(spark, path, browser), limit=-1)

    return run, WRAP[browser](sql)


def _history(operator: Callable, sql: str, *args, deleted: bool = True, **options):
    """A report over the one history of three snapshots, landed in a folder of this run."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_folder(spark)}/landed-{uuid.uuid4()}"
        rows = fixtures.chromium_snapshots(spark, sf_dir).withColumn("browser", F.lit("chrome"))
        rows.write.partitionBy("browser", "snapshot", "table_name", "month").parquet(f"{path}/chromium")
        snapshots.keep_digests(spark, path, "chrome")
        return operator(snapshots.landed_history(spark, path, "chrome", deleted), *args, **options)

    return run, sql


def _landed(browser: str, operator: Callable, sql: Callable, **options):
    """A report over landed tables, in a folder of this run."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_folder(spark)}/landed-{uuid.uuid4()}"
        rows = fixtures.landed(spark, sf_dir, browser)
        family = "chromium" if browser == "chrome" else browser
        rows.write.partitionBy("browser", "snapshot", "table_name", "month").parquet(f"{path}/{family}")
        return operator(history_files.landed_tables(spark, path, browser), **options)

    return run, WRAP[browser](sql(**options))


def _clustered(operator: Callable, sql: str, profiles: list[str] | None = None, **options):
    """A report over two profiles' tables clustered by profile and time, in a folder of this run."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_folder(spark)}/clustered-{uuid.uuid4()}"
        clustered_tables.keep_clustered(fixtures.chromium_fleet(spark, sf_dir), "chrome", path, file_rows=2000)
        return operator(clustered_tables.ClusteredTables(spark, path, "chrome", profiles), **options)

    return run, sql


def _quoted(browser: str, operator: Callable, sql: Callable, fmt: str, texts: list[str], **options):
    """A report written as quoted lines and read back; what is missing comes back as NULL, like empty text."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_folder(spark)}/report-{uuid.uuid4()}"
        report = operator(TABLES[browser](spark, sf_dir), **options)
        text.write_report(report, path, fmt)
        reader = spark.read.option("sep", text.SEPARATORS[fmt]).option("header", True).option("escape", '"')
        back = reader.option("multiLine", True).schema(report.schema).csv(path)
        return back.select(*(F.nullif(c, F.lit("")).alias(c) if kind == "string" else F.col(c) for c, kind in report.dtypes))

    texts = ", ".join(f"nullif({c}, '') AS {c}" for c in texts)
    return run, WRAP[browser](f"SELECT * REPLACE ({texts}) FROM (\n{sql(**options)})")


def _rolled(browser: str, zone: str = "UTC", **dates):
    """A summary from daily counts put together from two halves of the visits."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = TABLES[browser](spark, sf_dir)
        visits = summary.LAYOUTS[browser].visits
        halves = [rollup.daily({visits: tables[visits].where(f"id % 2 = {half}")}, browser) for half in (0, 1)]
        return rollup.summary(rollup.put_together(browser, *halves), tables, browser, **dates, tz=zone)

    return run, oracle.summary(browser, **dates, zone=zone)


def _odd_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saved_tabs.saved_tabs(fixtures.odd_tab_files(spark, sf_dir), 0)


def _zoned(operator: Callable, sql: Callable, browser: str, **options):
    return _report(browser, operator, sql, {**options, "zone": NEW_YORK}, **options, tz=NEW_YORK)


def registry() -> dict[str, tuple[Query, str]]:
    """Query name -> (Spark query, oracle SQL)."""
    visit_columns = "url title visit_time duration_sec transition from_url"
    url_columns = "url title visit_count typed_count last_visit_time"
    return {
        # Chrome
        "chrome_urls": _report("chrome", chromium.urls, oracle.chromium_urls),
        "chrome_urls_all": _report("chrome", chromium.urls, oracle.chromium_urls, **EVERY),
        "chrome_visits": _report("chrome", chromium.visits, oracle.chromium_visits, **WEEK),
        "chrome_visits_all": _report("chrome", chromium.visits, oracle.chromium_visits, **EVERY),
        "chrome_visits_new_york": _zoned(chromium.visits, oracle.chromium_visits, "chrome", **WEEK),
        "chrome_searches": _report("chrome", chromium.searches, oracle.chromium_searches, **SINCE),
        "chrome_searches_all": _report("chrome", chromium.searches, oracle.chromium_searches, **EVERY),
        "chrome_downloads": _report("chrome", chromium.downloads, oracle.chromium_downloads),
        "chrome_downloads_new_york": _zoned(chromium.downloads, oracle.chromium_downloads, "chrome", **UNTIL),
        "chrome_annotations": _report("chrome", chromium.annotations, oracle.chromium_annotations, **UNTIL),
        "chrome_annotations_all": _report("chrome", chromium.annotations, oracle.chromium_annotations, **EVERY),
        "chrome_contexts": _report("chrome", chromium.contexts, oracle.chromium_contexts, **WEEK),
        "chrome_contexts_all": _report("chrome", chromium.contexts, oracle.chromium_contexts, **EVERY),
        "chrome_summary_basic": _section("chrome", summary.basic, oracle.summary_basic),
        "chrome_summary_domains": _section("chrome", summary.domains, oracle.summary_domains, **WEEK),
        "chrome_summary_transitions": _section("chrome", summary.types, oracle.summary_types, **SINCE),
        "chrome_summary": _section("chrome", summary.summary, oracle.summary, **WEEK),
        "chrome_summary_empty": _section("chrome", summary.summary, oracle.summary, **EMPTY),
        # two profiles with the same ids
        "fleet_visits": _fleet(chromium.visits, oracle.fleet_visits(100, False)),
        "fleet_visits_per_profile": _fleet(chromium.visits, oracle.fleet_visits(100, True), per_profile=True),
        "fleet_basic_per_profile": _fleet(summary.basic, oracle.fleet_basic(), "chrome", per_profile=True),
        "fleet_domains_per_profile": _fleet(summary.domains, oracle.fleet_domains(), "chrome", per_profile=True),
        # one history of three snapshots
        "history_visits_all": _history(chromium.visits, oracle.history_visits(), **EVERY),
        "history_annotations_all": _history(chromium.annotations, oracle.history_annotations(), **EVERY),
        "history_summary_basic": _history(summary.basic, oracle.history_basic(), "chrome", deleted=False),
        # tables kept in buckets
        "keyed_visits_all": _keyed("chrome", chromium.visits, oracle.chromium_visits(**EVERY)),
        "keyed_contexts_all": _keyed("chrome", chromium.contexts, oracle.chromium_contexts(**EVERY)),
        "keyed_searches_all": _keyed("chrome", chromium.searches, oracle.chromium_searches(**EVERY)),
        "keyed_firefox_visits_all": _keyed("firefox", firefox.visits, oracle.firefox_visits(**EVERY)),
        "keyed_safari_visits_all": _keyed("safari", safari.visits, oracle.safari_visits(**EVERY)),
        # landed tables, clustered tables, quoted files
        "landed_chrome_visits": _landed("chrome", chromium.visits, oracle.chromium_visits, **WEEK),
        "landed_firefox_visits": _landed("firefox", firefox.visits, oracle.firefox_visits, **WEEK),
        "landed_firefox_bookmarks": _landed("firefox", firefox.bookmarks, oracle.firefox_bookmarks),
        "landed_safari_visits": _landed("safari", safari.visits, oracle.safari_visits, **SINCE),
        "landed_safari_urls": _landed("safari", safari.urls, oracle.safari_urls),
        "clustered_visits": _clustered(chromium.visits, oracle.fleet_visits(100, False)),
        "clustered_profile_visits": _clustered(chromium.visits, oracle.profile_visits("p1"), ["p1"], **WEEK, **EVERY),
        "chrome_visits_quoted_csv": _quoted(
            "chrome", chromium.visits, oracle.chromium_visits, "csv", ["url", "title", "from_url"], **WEEK
        ),
        "firefox_bookmarks_quoted_tsv": _quoted(
            "firefox", firefox.bookmarks, oracle.firefox_bookmarks, "tsv", ["title", "url", "parent_title"], **EVERY
        ),
        # daily counts, leading domains
        "rolled_chrome_summary": _rolled("chrome", NEW_YORK, **WEEK),
        "rolled_firefox_summary": _rolled("firefox"),
        "rolled_safari_summary": _rolled("safari", NEW_YORK, **SINCE),
        "chrome_leading_domains": _section("chrome", summary.leading_domains, oracle.summary_domains),
        "safari_leading_domains": _section("safari", summary.leading_domains, oracle.summary_domains, **WEEK),
        # Edge
        "edge_urls": _report("edge", chromium.urls, oracle.chromium_urls, **WEEK),
        "edge_visits": _report("edge", chromium.visits, oracle.chromium_visits),
        "edge_searches": _report("edge", chromium.searches, oracle.chromium_searches),
        "edge_downloads": _report("edge", chromium.downloads, oracle.chromium_downloads, **SINCE),
        "edge_summary_basic": _section("edge", summary.basic, oracle.summary_basic, **WEEK),
        "edge_summary_domains": _section("edge", summary.domains, oracle.summary_domains),
        "edge_summary": _section("edge", summary.summary, oracle.summary, **UNTIL),
        # Firefox
        "firefox_urls": _report("firefox", firefox.urls, oracle.firefox_urls),
        "firefox_urls_range": _report("firefox", firefox.urls, oracle.firefox_urls, **WEEK),
        "firefox_urls_new_york": _zoned(firefox.urls, oracle.firefox_urls, "firefox", **SINCE, **EVERY),
        "firefox_visits": _report("firefox", firefox.visits, oracle.firefox_visits, **SINCE),
        "firefox_visits_all": _report("firefox", firefox.visits, oracle.firefox_visits, **EVERY),
        "firefox_searches": _report("firefox", firefox.searches, oracle.firefox_searches),
        "firefox_searches_all": _report("firefox", firefox.searches, oracle.firefox_searches, **EVERY),
        "firefox_bookmarks": _report("firefox", firefox.bookmarks, oracle.firefox_bookmarks),
        "firefox_bookmarks_all": _report("firefox", firefox.bookmarks, oracle.firefox_bookmarks, **EVERY),
        "firefox_summary_basic": _section("firefox", summary.basic, oracle.summary_basic, **WEEK),
        "firefox_summary_domains": _section("firefox", summary.domains, oracle.summary_domains, **UNTIL),
        "firefox_summary_types": _section("firefox", summary.types, oracle.summary_types),
        "firefox_summary": _section("firefox", summary.summary, oracle.summary),
        # Safari
        "safari_urls": _report("safari", safari.urls, oracle.safari_urls),
        "safari_urls_range": _report("safari", safari.urls, oracle.safari_urls, **WEEK),
        "safari_urls_real_time": _report("safari", safari.urls, oracle.safari_urls, last_visit="max_visit_time", **EVERY),
        "safari_visits": _report("safari", safari.visits, oracle.safari_visits, **WEEK),
        "safari_visits_all": _report("safari", safari.visits, oracle.safari_visits, **EVERY),
        "safari_summary_basic": _section("safari", summary.basic, oracle.summary_basic, **SINCE),
        "safari_summary_domains": _section("safari", summary.domains, oracle.summary_domains, **WEEK),
        "safari_summary": _section("safari", summary.summary, oracle.summary, **WEEK),
        # saved tabs
        "onetab": _tabs(True, 100),
        "onetab_all": _tabs(True, 0),
        "onetab_fallback": _tabs(False, 100),
        "onetab_odd": (_odd_tabs, oracle.odd_saved_tabs()),
        # sinks
        "chrome_visits_tsv": _lines("chrome", chromium.visits, oracle.chromium_visits, visit_columns, "tsv", **WEEK),
        "chrome_urls_csv": _lines("chrome", chromium.urls, oracle.chromium_urls, url_columns, "csv"),
        "chrome_summary_text": _summary_text("chrome", **WEEK),
        "edge_summary_text": _summary_text("edge", **SINCE),
        "firefox_summary_text": _summary_text("firefox"),
        "safari_summary_text": _summary_text("safari", **UNTIL),
        "chrome_visit_pairs": (
            _visit_pairs,
            oracle.chromium(f"SELECT visit_time, url FROM (\n{oracle.chromium_visits()})"),
        ),
        "firefox_visit_count_lines": (
            _visit_count_lines,
            oracle.firefox(f"SELECT title || ' (' || visit_count || ' visits)' AS line FROM (\n{oracle.firefox_urls()})"),
        ),
        # sources
        "profile_select": _profiles("chrome"),
        "profile_select_firefox": _profiles("firefox"),
        "sqlite_ingest": (_ingested_visits, oracle.sqlite_ingest()),
        "sqlite_rejected": (_rejected_files, oracle.sqlite_rejected()),
    }
