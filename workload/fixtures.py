"""History tables derived from the ``events`` and ``pages`` test tables, in Spark.

``workload.oracle`` states the same rules in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagetrail.schemas import CHROMIUM, FAMILIES, PROFILE

FILE_ROWS = 500

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
PAGES = "page_id bigint, url string, html string"

PROFILE_COLUMN = f"'p0' AS {PROFILE}"


class Derived(Mapping):
    """Named tables, each built when it is asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers = makers

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


class Base:
    """The two source tables with the derived columns the rules share."""

    def __init__(self, spark: SparkSession, sf_dir: str, events_filter: str = "true"):
        self._pages = spark.read.schema(PAGES).parquet(f"{sf_dir}/pages.parquet")
        self._events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
        self._filter = events_filter

    def pages(self, *columns: str) -> DataFrame:
        url = """CASE page_id % 25
            WHEN 3 THEN concat('http://nopath-', page_id, '.example')
            WHEN 7 THEN concat('about:page', page_id)
            WHEN 11 THEN concat('file:///home/u/', page_id)
            WHEN 15 THEN concat('https://www.awww.example:8080/www.x/', page_id)
            ELSE url END AS url"""
        shared = self._pages.selectExpr(
            "page_id AS p",
            url,
            "url AS plain_url",
            "regexp_extract(html, '<title>([^<]*)</title>', 1) AS page_title",
            "page_id * 7919 % 2592000 AS spread",
            "page_id * 13 % 50 AS visit_count",
        )
        return shared.selectExpr(PROFILE_COLUMN, *columns)

    def events(self, *columns: str, where: str = "true") -> DataFrame:
        page_rows = self._pages.agg(F.count("*")).scalar().alias("page_rows")
        event_rows = self._events.agg(F.count("*")).scalar().alias("event_rows")
        shared = self._events.where(self._filter).select("*", page_rows, event_rows)
        shared = shared.selectExpr(
            "event_id AS e",
            "user_id AS u",
            "event_type AS t",
            "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS m",
            "cast(round(value * 100) AS bigint) AS c",
            "cast(get_json_object(props, '$.k') AS bigint) AS k",
            "page_rows",
            "CASE WHEN event_id % 97 = 0 THEN page_rows + 1 "
            "ELSE (user_id * 7 + event_id % 11) % page_rows + 1 END AS url_id",
            "CASE WHEN event_id % 5 = 0 THEN 0 WHEN event_id % 89 = 0 THEN event_rows + 1000 "
            "ELSE event_id END AS from_id",
            "event_rows DIV 4 AS quarter",
        )
        return shared.where(where).selectExpr(PROFILE_COLUMN, *columns)


def chromium(spark: SparkSession, sf_dir: str, events_filter: str = "true") -> Derived:
    base = Base(spark, sf_dir, events_filter)
    webkit = "m + 11644473600000000"
    return Derived(
        {
            "urls": lambda: base.pages(
                "p + 1 AS id",
                "url",
                "if(p % 17 = 0, NULL, page_title) AS title",
                "visit_count",
                "visit_count % 7 AS typed_count",
                "if(p % 31 = 0, 0, 13348540800000000 + spread * 1000000) AS last_visit_time",
            ),
            "visits": lambda: base.events(
                "e + 1 AS id",
                "url_id AS url",
                f"{webkit} AS visit_time",
                "from_id AS from_visit",
                "if(e % 101 = 0, NULL, 805306368 + e * 7 % 13) AS transition",
                "c * 10000 AS visit_duration",
            ),
            "keyword_search_terms": lambda: base.events(
                "concat('term ', k) AS term", "e % (page_rows + 3) + 1 AS url_id", where="t = 'click' AND e % 4 = 0"
            ),
            "downloads": lambda: base.events(
                "e + 1 AS id",
                "concat('/home/u/dl/f', e, '.bin') AS target_path",
                "c * 1024 AS total_bytes",
                "array('application/pdf', 'image/png', '')[int(e % 3)] AS mime_type",
                "if(e % 41 = 0, NULL, e % 6) AS state",
                f"{webkit} AS start_time",
                "if(e % 2 = 0, NULL, concat('https://dl.example/', u)) AS tab_url",
                "if(e % 3 = 0, NULL, 'https://ref.example/') AS referrer",
                where="t = 'purchase'",
            ),
            "content_annotations": lambda: base.events(
                "e + 1 AS visit_id",
                "if(e % 2 = 0, NULL, concat('/m/0', k)) AS categories",
                "if(e % 7 = 0, NULL, 'en') AS page_language",
                "if(e % 4 = 0, concat('q ', k), NULL) AS search_terms",
                where="e % 3 = 0",
            ),
            "context_annotations": lambda: base.events(
                "e + 1 AS visit_id",
                "if(e % 10 = 0, -1000000, c * 5000) AS total_foreground_duration",
                "array(200L, 404L, 0L)[int(e % 3)] AS response_code",
                "u AS tab_id",
                "u % 5 AS window_id",
                where="e % 2 = 0",
            ),
        }
    )


def chromium_fleet(spark: SparkSession, sf_dir: str) -> Derived:
    """Two profiles with the same ids: the second's URLs are marked, and its visits are half an hour older."""
    first = chromium(spark, sf_dir)
    second = {"urls": ("url", "concat(url, '?p1')"), "visits": ("visit_time", "visit_time - 1800000001")}

    def both(name: str) -> DataFrame:
        changed = first[name].withColumn(PROFILE, F.lit("p1"))
        if name in second:
            column, value = second[name]
            changed = changed.withColumn(column, F.expr(value))
        return first[name].unionByName(changed)

    return Derived({name: lambda name=name: both(name) for name in first})


def chromium_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows of three snapshots of one profile, by six days instead of months.

    The first snapshot has the older half of the visits. The second lacks the oldest eighth, which expired, and every
    41st of the first, which were deleted; the third lacks the oldest quarter and has the newest visits. Every 29th of
    the newest has the id of an expired one. From the third on, every 19th page id is that of another URL; titles are
    old ones in the first.
    """
    base = Base(spark, sf_dir)
    visit = "if(e >= 3 * quarter AND e < 4 * quarter AND e % 29 = 0, e + 1 - 3 * quarter, e + 1)"
    before = "if(from_id = e AND e > 3 * quarter AND e <= 4 * quarter AND (e - 1) % 29 = 0, e - 3 * quarter, from_id)"
    stays = "NOT (e % 41 = 0 AND e < 2 * quarter)"
    snapshots = {
        "s1": "e < 2 * quarter",
        "s2": f"e >= quarter DIV 2 AND e < 3 * quarter AND {stays}",
        "s3": f"e >= quarter AND {stays}",
    }
    columns = {table: [f.name for f in StructType.fromDDL(ddl)] for table, ddl in CHROMIUM.items()}
    structs = {t: f"struct<{ddl.replace(' ', ':').replace(',:', ', ')}>" for t, ddl in CHROMIUM.items()}

    def landed(rows: DataFrame, table: str, snapshot: str, month: str) -> DataFrame:
        values = [
            f"named_struct({', '.join(f'{c!r}, {c}' for c in columns[t])}) AS {t}" if t == table else f"cast(NULL AS {kind}) AS {t}"
            for t, kind in structs.items()
        ]
        names = [f"'{table}' AS table_name", "cast(NULL AS string) AS error", f"'{snapshot}' AS snapshot", f"{month} AS month"]
        return rows.selectExpr(PROFILE, *names, *values)

    parts = []
    for snapshot, where in snapshots.items():
        visits = base.events(
            f"{visit} AS id",
            "url_id AS url",
            "m + 11644473600000000 AS visit_time",
            f"{before} AS from_visit",
            "if(e % 101 = 0, NULL, 805306368 + e * 7 % 13) AS transition",
            # a duration is known only once the next visit was made
            f"if({snapshot == 's1'} AND e = 2 * quarter - 1, 0, c * 10000) AS visit_duration",
            where=where,
        )
        notes = base.events(
            f"{visit} AS visit_id",
            "if(e % 2 = 0, NULL, concat('/m/0', k)) AS categories",
            "if(e % 7 = 0, NULL, 'en') AS page_language",
            "if(e % 4 = 0, concat('q ', k), NULL) AS search_terms",
            where=f"e % 3 = 0 AND {where}",
        )
        pages = base.pages(
            "p + 1 AS id",
            f"if({snapshot == 's3'} AND p % 19 = 0, concat(url, '#new'), url) AS url",
            f"if(p % 17 = 0, NULL, concat('{'old ' if snapshot == 's1' else ''}', page_title)) AS title",
            "visit_count",
            "visit_count % 7 AS typed_count",
            "13348540800000000 AS last_visit_time",
        )
        day = "cast(visit_time DIV 518400000000 AS string)"
        parts += [landed(visits, "visits", snapshot, day), landed(notes, "content_annotations", snapshot, "'undated'")]
        parts += [landed(pages, "urls", snapshot, "'undated'")]
        read = base.pages("p").limit(1)
        nothing = [f"cast(NULL AS {kind}) AS {t}" for t, kind in structs.items()]
        names = ["'read' AS table_name", "cast(NULL AS string) AS error", f"'{snapshot}' AS snapshot", "'undated' AS month"]
        parts.append(read.selectExpr(PROFILE, *names, *nothing))
    return reduce(DataFrame.unionByName, parts)


def landed(spark: SparkSession, sf_dir: str, browser: str) -> DataFrame:
    """Landed rows of one snapshot of the derived tables, with their months."""
    family = FAMILIES[browser]
    tables = {"firefox": firefox, "safari": safari}.get(browser, chromium)(spark, sf_dir)
    structs = {t: f"struct<{ddl.replace(' ', ':').replace(',:', ', ')}>" for t, ddl in family.items()}
    parts = []
    for table, ddl in family.items():
        columns = [f.name for f in StructType.fromDDL(ddl)]
        values = [
            f"named_struct({', '.join(f'{c!r}, {c}' for c in columns)}) AS {t}" if t == table else f"cast(NULL AS {kind}) AS {t}"
            for t, kind in structs.items()
        ]
        names = [f"'{table}' AS table_name", "cast(NULL AS string) AS error", "'2024-01' AS month", "'s1' AS snapshot"]
        parts.append(tables[table].selectExpr(PROFILE, *names, *values))
    marks = parts[0].limit(1).selectExpr(
        PROFILE, "'read' AS table_name", "error", "month", "snapshot", *(f"cast(NULL AS {k}) AS {t}" for t, k in structs.items())
    )
    return reduce(DataFrame.unionByName, [*parts, marks]).withColumn("browser", F.lit(browser))


def edge(spark: SparkSession, sf_dir: str) -> Derived:
    return chromium(spark, sf_dir, "user_id % 2 = 1")


def firefox(spark: SparkSession, sf_dir: str) -> Derived:
    base = Base(spark, sf_dir)
    unix = "1704067200000000 + spread * 1000000"
    return Derived(
        {
            "moz_places": lambda: base.pages(
                "p + 1 AS id",
                "url",
                "if(p % 17 = 0, NULL, page_title) AS title",
                "visit_count",
                f"if(p % 31 = 0, NULL, {unix}) AS last_visit_date",
            ),
            "moz_historyvisits": lambda: base.events(
                "e + 1 AS id",
                "from_id AS from_visit",
                "url_id AS place_id",
                "m AS visit_date",
                "if(e % 101 = 0, NULL, e % 12) AS visit_type",
            ),
            "moz_inputhistory": lambda: base.events(
                "e % (page_rows + 3) + 1 AS place_id",
                "concat('in ', k) AS input",
                "c / 100 AS use_count",
                where="t = 'view' AND e % 4 = 0",
            ),
            "moz_bookmarks": lambda: base.pages(
                "p + 1 AS id",
                "CASE WHEN p < 10 THEN 2L WHEN p % 13 = 0 THEN 3L ELSE 1L END AS type",
                "if(p < 10 OR p % 19 = 0, NULL, p + 1) AS fk",
                "if(p % 23 = 0, 99999999L, p % 10 + 1) AS parent",
                "if(p % 29 = 0, NULL, concat('bm ', p)) AS title",
                f"{unix} AS dateAdded",
            ),
        }
    )


def safari(spark: SparkSession, sf_dir: str) -> Derived:
    base = Base(spark, sf_dir)
    return Derived(
        {
            "history_items": lambda: base.pages(
                "p + 1 AS id", "url", "visit_count", "cast(725760000 + spread AS double) AS visit_count_score"
            ),
            "history_visits": lambda: base.events(
                "e + 1 AS id",
                "url_id AS history_item",
                "(m - 978307200000000) / 1000000 AS visit_time",
                "CASE WHEN url_id % 13 = 0 OR e % 3 = 0 THEN NULL WHEN e % 3 = 1 AND e % 2 = 0 THEN '' "
                "ELSE concat('t ', e) END AS title",
                "from_id AS redirect_source",
                "if(e % 6 = 0, e + 2, NULL) AS redirect_destination",
            ),
        }
    )


def saved_tab_files(spark: SparkSession, sf_dir: str, grouped: bool = True) -> DataFrame:
    """One storage file per 20 pages; without ``grouped`` no group can be recognised."""
    word = "createDate" if grouped else "createDat"
    form = '\'{"id":"%d","url":"%s","title":"%s"}\''
    tabs = Base(spark, sf_dir).pages(
        "p DIV 20 AS g",
        f"struct(p, format_string({form}, p, plain_url, regexp_replace(page_title, '[^A-Za-z0-9 ]', '')) AS json) AS tab",
    )
    files = tabs.groupBy(PROFILE, "g").agg(F.sort_array(F.collect_list("tab")).alias("tabs"))
    return files.selectExpr(
        PROFILE,
        "format_string('%06d.ldb', g) AS file_name",
        f"cast(concat('xx[', concat_ws(',', tabs.json), '],\"{word}\":', 1704067200000 + g * 60000, 'yy') AS binary)"
        " AS content",
    )


def odd_tab_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage files with and without groups, whose tabs are repeated, too long, broken, blank or full of control bytes.

    The first two files and every third have no readable group.
    """
    loose = "(p DIV 20 < 2 OR p DIV 20 % 3 = 0)"
    tabs = Base(spark, sf_dir)._pages.selectExpr(
        "page_id AS p", "page_id DIV 20 AS g", "regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[^A-Za-z0-9 ]', '') AS said"
    )
    shown = f"""CASE p % 10 WHEN 0 THEN concat('"', repeat('x', 500), '"') WHEN 1 THEN concat('"', repeat('y', 501), '"')
        WHEN 2 THEN if({loose}, concat('"a\\x01b', chr(127), ' ', said, '"'), concat('"', said, '"'))
        WHEN 3 THEN concat('"', chr(255), said, '"') WHEN 4 THEN 'null' ELSE concat('"', said, '"') END"""
    page = "CASE p % 10 WHEN 5 THEN p - 5 WHEN 6 THEN p - 5 WHEN 8 THEN p % 40 ELSE p END"
    url = f"concat('https://tab.example/', {page}, if(p % 10 = 7 AND {loose}, chr(2), ''))"
    shown = shown.replace("\\x01", "', chr(1), '")
    tabs = tabs.selectExpr("g", f"struct(p, concat('{{\"url\":\"', {url}, '\",\"title\":', {shown}, '}}') AS json) AS tab")
    files = tabs.groupBy("g").agg(F.sort_array(F.collect_list("tab")).alias("tabs"))
    date = "if(g < 2 OR g % 3 = 0, 'createDat', 'createDate')"
    return files.selectExpr(
        PROFILE_COLUMN,
        "format_string('%06d.ldb', g) AS file_name",
        # one byte a character, so that 255 is a byte that UTF-8 does not know
        f"encode(concat('xx[', concat_ws(',', tabs.json), '],\"', {date}, '\":', 1704067200000 + g * 60000, 'yy'), 'ISO-8859-1') AS content",
    )


def profile_listing(spark: SparkSession, sf_dir: str, browser: str) -> DataFrame:
    """A file listing with one root per seven pages; each page adds one file."""
    if browser == "firefox":
        folder = """CASE page_id % 5 WHEN 0 THEN concat(name, '.default-release') WHEN 1 THEN concat(name, '.default')
            WHEN 2 THEN concat(name, '.default-esr') ELSE concat('work-', name) END"""
        file_name = "if(page_id % 4 = 3, 'prefs.js', 'places.sqlite')"
    else:
        folder = "if(page_id % 17 = 0, 'Default', concat('Profile ', name))"
        file_name = "if(page_id % 4 = 3, 'Cookies', 'History')"
    pages = spark.read.schema(PAGES).parquet(f"{sf_dir}/pages.parquet")
    return pages.selectExpr("page_id", "cast(page_id * 7919 % 13 AS string) AS name").selectExpr(
        "concat('/fleet/', page_id DIV 7) AS root",
        f"""CASE WHEN page_id DIV 7 % 9 = 4 THEN NULL WHEN page_id % 11 = 0 THEN 'places.sqlite'
            ELSE concat({folder}, '/', {file_name}) END AS rel_path""",
    )


def sqlite_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(profile_id, content): one Chromium database per 500 consecutive events, every fourth in WAL mode."""
    import sqlite3

    import pandas as pd

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        number = int(rows["file_no"].iloc[0])
        db = sqlite3.connect(":memory:")
        db.execute(
            "CREATE TABLE visits (id INTEGER PRIMARY KEY, url INTEGER, visit_time INTEGER, "
            "from_visit INTEGER, transition INTEGER, visit_duration INTEGER)"
        )
        db.execute("CREATE TABLE keyword_search_terms (keyword_id INTEGER, url_id INTEGER, term TEXT)")
        table = rows[["id", "url", "visit_time", "from_visit", "transition", "visit_duration"]].astype(object)
        table = table.where(table.notna(), None)
        db.executemany("INSERT INTO visits VALUES (?,?,?,?,?,?)", table.itertuples(index=False, name=None))
        db.commit()
        image = bytearray(db.serialize())
        if number % 4 == 3:
            image[18:20] = b"\x02\x02"
        if number % 10 == 9:
            image = image[: len(image) // 2]
        return pd.DataFrame({PROFILE: [f"f{number}"], "content": [bytes(image)]})

    visits = chromium(spark, sf_dir)["visits"].withColumn(
        "file_no", F.floor((F.col("id") - 1) / FILE_ROWS).cast("bigint")
    )
    return visits.groupBy("file_no").applyInPandas(build, f"{PROFILE} string, content binary")
