import re
import sqlite3

import pytest
from rows import tuples
from pyspark.errors import AnalysisException

from pagetrail.operators import chromium, firefox, summary
from pagetrail.sources import history_files, profiles
from pagetrail.sources.saved_tab_files import saved_tab_files


@pytest.fixture
def listing(spark):
    return lambda rows: spark.createDataFrame(rows, "root string, rel_path string")


def test_chromium_profiles(listing):
    rows = [
        ("r1", "Default/History"), ("r1", "Profile 1/History"),
        ("r2", "Profile 10/History"), ("r2", "Profile 2/History"), ("r2", "System Profile/History"),
        ("r3", "Profile 1/Cookies"), ("r3", "Profile 2/History"),
        ("r4", None),
        ("r5", "Profile 3/sub/History"),
    ]
    got = sorted(tuples(profiles.select_profiles(listing(rows), "chrome")))
    assert got == [
        ("r1", "Default/History", True),
        ("r2", "Profile 10/History", True),
        ("r3", "Default/History", False),
        ("r4", "Default/History", False),
        ("r5", "Default/History", False),
    ]
    everything = profiles.select_profiles(listing(rows), "edge", all_profiles=True)
    assert everything.count() == 6


def test_firefox_profiles(listing):
    rows = [
        ("r1", "abc.default-release/places.sqlite"), ("r1", "aaa.default/places.sqlite"),
        ("r2", "xyz.default/places.sqlite"), ("r2", "work/places.sqlite"),
        ("r3", "z.default-release/prefs.js"), ("r3", "a.default/places.sqlite"), ("r3", "places.sqlite"),
        ("r4", None),
        ("r5", "b.default-release-1/places.sqlite"),
    ]
    got = sorted(tuples(profiles.select_profiles(listing(rows), "firefox")))
    assert got == [
        ("r1", "abc.default-release/places.sqlite", True),
        ("r2", "xyz.default/places.sqlite", True),
        ("r3", "places.sqlite", True),
        ("r4", "places.sqlite", False),
        ("r5", "b.default-release-1/places.sqlite", True),
    ]


def test_safari_needs_a_path(listing):
    with pytest.raises(ValueError):
        profiles.select_profiles(listing([("r", "History.db")]), "safari")


def test_saved_tab_dirs(listing):
    rows = [("r1", "Default/x"), ("r1", "Profile 1/x"), ("r2", "Profile 2/x"), ("r2", "Profile 1/y"), ("r3", "readme")]
    got = {r[0]: r[1].split("/")[0] for r in tuples(profiles.saved_tab_dirs(listing(rows)))}
    assert got == {"r1": "Default", "r2": "Profile 1", "r3": "Default"}


CHROMIUM_DDL = """
CREATE TABLE urls (id INTEGER PRIMARY KEY, url TEXT, title TEXT, visit_count INTEGER, typed_count INTEGER, last_visit_time INTEGER, hidden INTEGER);
CREATE TABLE visits (id INTEGER PRIMARY KEY, url INTEGER, visit_time INTEGER, from_visit INTEGER, transition INTEGER, visit_duration INTEGER);
CREATE TABLE downloads (id INTEGER PRIMARY KEY, target_path TEXT, total_bytes INTEGER, state INTEGER, start_time INTEGER);
"""


def chromium_db(path, rows=10, wal=False):
    db = sqlite3.connect(path)
    if wal:
        db.execute("PRAGMA journal_mode=WAL")
    db.executescript(CHROMIUM_DDL)
    start = 13348540800000000
    db.executemany("INSERT INTO urls VALUES (?,?,?,1,0,?,0)", [(i, f"https://h{i}/", None if i == 1 else "t", start + i) for i in range(1, rows + 1)])
    db.executemany("INSERT INTO visits VALUES (?,?,?,?,?,?)", [(i, i, start + i, i - 1, 0, 100_000) for i in range(1, rows + 1)])
    db.execute("INSERT INTO visits VALUES (500, 'not a number', ' 12 ', 7.0, 7.5, x'00')")
    db.execute("INSERT INTO downloads VALUES (1, x'ff41', 5, 1, ?)", (start,))
    db.commit()
    db.close()


@pytest.fixture
def fleet(tmp_path):
    for name, wal in (("u1", False), ("u2", True)):
        (tmp_path / name).mkdir()
        chromium_db(tmp_path / name / "History", wal=wal)
    whole = (tmp_path / "u1" / "History").read_bytes()
    for name, content in (("u3", whole[: len(whole) // 2]), ("u4", b"not a database"), ("u5", b"")):  # Spark lists no empty files
        (tmp_path / name).mkdir()
        (tmp_path / name / "History").write_bytes(content)
    (tmp_path / "u1" / "Cookies").write_bytes(b"ignored")
    return tmp_path


def test_ingest_land_and_report(spark, fleet, tmp_path):
    files = history_files.history_files(spark, str(fleet), "chrome", recursive=True)
    history_files.land(files, "chrome", f"{tmp_path}/landed", "2024-01-08")
    rows = history_files.landed(spark, f"{tmp_path}/landed", "chrome")
    bad = sorted(r.profile_id[-2:] for r in history_files.rejected(rows).collect())
    assert bad == ["u3", "u4"]
    tables = history_files.landed_tables(spark, f"{tmp_path}/landed", "chrome")
    assert tables["urls"].count() == 20 and tables["visits"].count() == 22
    odd = tables["visits"].where("id = 500").drop("profile_id").distinct()
    assert tuples(odd) == [(500, None, 12, 7, None, None)]
    assert {r.target_path for r in tables["downloads"].collect()} == {"�A"}
    assert tables["downloads"].where("mime_type IS NULL").count() == 2  # a column older files lack
    assert tables["content_annotations"].count() == 0  # a table they lack
    plan = chromium.visits(tables, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(visits.visit_time,13348540800000000)" in plan
    scans = re.findall(r"PartitionFilters: \[([^\n]*?)\], PushedFilters.*ReadSchema: struct<([^\n]*)>", plan)
    assert scans and all("table_name" in filters and "browser" in filters for filters, _ in scans)
    assert not any("visits:" in schema and "urls:" in schema for _, schema in scans)
    assert any("visits:struct<id:bigint,url:bigint>" in schema for _, schema in scans), scans
    got = chromium.visits(tables, limit=3).collect()
    assert [r.url for r in got] == ["https://h10/", "https://h10/", "https://h9/"]
    assert got[0].from_url == "https://h9/" and got[0].duration_sec == 0.1


def test_landing_again_changes_no_report(spark, tmp_path):
    """A snapshot landed twice counts once, a newer one replaces it profile by profile."""
    path = f"{tmp_path}/landed"

    def fleet(day, **rows):
        for name, n in rows.items():
            (tmp_path / day / name).mkdir(parents=True)
            file = tmp_path / day / name / "History"
            chromium_db(file, rows=n) if n else file.write_bytes(b"not a database")
        files = history_files.history_files(spark, str(tmp_path / day), "chrome", recursive=True)
        return files.selectExpr("regexp_extract(profile_id, '[^/]*$', 0) AS profile_id", "content")

    def state(**options):
        rows = history_files.landed(spark, path, "chrome", **options)
        visits = history_files.tables_from(rows, "chrome")["visits"].groupBy("profile_id").count()
        return dict(tuples(visits)), sorted(r.profile_id for r in history_files.rejected(rows).collect())

    first = fleet("d1", u1=3, u2=5, u4=0)
    history_files.land(first, "chrome", path, "2024-01-08")
    assert state() == ({"u1": 4, "u2": 6}, ["u4"])
    history_files.land(first, "chrome", path, "2024-01-08")
    assert state() == ({"u1": 4, "u2": 6}, ["u4"])
    history_files.land(fleet("d2", u1=4, u2=0, u3=1), "chrome", path, "2024-01-09")
    assert state() == ({"u1": 5, "u2": 6, "u3": 2}, ["u4"])  # u2's newest readable file is the first
    assert state(snapshot="2024-01-09") == ({"u1": 5, "u3": 2}, ["u2"])
    tables = history_files.landed_tables(spark, path, "chrome")
    assert tuples(summary.basic(tables, "chrome").select("total_visits")) == [(13,)]
    assert chromium.visits(tables, limit=-1).count() == 10  # one visit of each profile has no page
    assert chromium.visits(tables).count() == 10
    with pytest.raises(ValueError):
        history_files.land(first, "chrome", path, "../x")


def test_landed_rows_are_sorted_by_time_within_months(spark, tmp_path):
    """Each landed file holds one month of one table in ascending order of time, so row groups can be skipped."""
    db = sqlite3.connect(tmp_path / "History")
    db.executescript(CHROMIUM_DDL)
    day = 86_400_000_000
    times = [13348540800000000 + (i * 7919 % 90) * day + i for i in range(500)]
    db.executemany("INSERT INTO visits VALUES (?,1,?,0,0,0)", enumerate([*times, 0, 2**62], start=1))
    db.commit()
    db.close()
    files = history_files.history_files(spark, f"{tmp_path}/History", "chrome")
    history_files.land(files, "chrome", f"{tmp_path}/landed", "s1")
    rows = history_files.landed(spark, f"{tmp_path}/landed", "chrome", "s1").where("table_name = 'visits'")
    got = rows.selectExpr("month", "visits.visit_time AS t", "input_file_name() AS file", "monotonically_increasing_id() AS place")
    got = got.collect()
    assert len(got) == 502 and {r.month for r in got} == {"2024-01", "2024-02", "2024-03", "undated"}
    for file in {r.file for r in got}:
        inside = [r.t for r in sorted((r for r in got if r.file == file), key=lambda r: r.place)]
        assert inside == sorted(inside)


def test_a_file_that_is_too_large_is_rejected(spark, fleet, monkeypatch):
    whole = (fleet / "u1" / "History").stat().st_size
    monkeypatch.setattr(history_files, "MAX_FILE_BYTES", whole - 1)
    rows = history_files.history_rows(history_files.history_files(spark, f"{fleet}/u1/History", "chrome"), "chrome")
    assert [(r.table_name, "more than" in r.error) for r in rows.collect()] == [("rejected", True)]


def test_other_chromium_browsers(spark, fleet, tmp_path):
    files = history_files.history_files(spark, str(fleet / "u1"), "brave", recursive=True)
    history_files.land(files, "brave", f"{tmp_path}/landed", "s1")
    tables = history_files.landed_tables(spark, f"{tmp_path}/landed", "brave")
    assert chromium.visits(tables, limit=1).collect()[0].url == "https://h10/"
    assert tuples(summary.basic(tables, "brave").select("total_visits")) == [(11,)]
    assert history_files.landed(spark, f"{tmp_path}/landed", "chrome").count() == 0


def test_ingest_chosen_profiles(spark, fleet, listing):
    rows = history_files.history_rows(history_files.history_files(spark, str(fleet), "chrome", recursive=True), "chrome")
    chosen = listing([(f"file:{fleet}", "u2/History")]).selectExpr("root", "rel_path AS db_path", "true AS found")
    tables = history_files.of_profiles(history_files.tables_from(rows, "chrome"), chosen)
    assert tables["urls"].count() == 10


def test_firefox_file_by_path(spark, tmp_path):
    path = tmp_path / "copy.sqlite"
    db = sqlite3.connect(path)
    db.executescript(
        "CREATE TABLE moz_places (id INTEGER PRIMARY KEY, url TEXT, title TEXT, visit_count INTEGER, last_visit_date INTEGER);"
        "CREATE TABLE moz_inputhistory (place_id INTEGER, input TEXT, use_count INTEGER);"
        "INSERT INTO moz_places VALUES (1, 'https://a/', 't', 2, 5); INSERT INTO moz_inputhistory VALUES (1, 'in', 0.975);"
    )
    db.close()
    rows = history_files.history_rows(history_files.history_files(spark, str(path), "firefox"), "firefox")
    tables = history_files.tables_from(rows, "firefox")
    assert tuples(firefox.searches(tables)) == [("in", "https://a/", "t", 0.975)]


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        history_files.history_files(spark, f"{tmp_path}/none/History", "chrome")


def test_saved_tab_files(spark, tmp_path):
    storage = tmp_path / "Default" / "Local Extension Settings" / "ext"
    storage.mkdir(parents=True)
    for name in ("000003.log", "000005.ldb", "CURRENT", "LOG"):
        (storage / name).write_bytes(b"x")
    got = sorted(tuples(saved_tab_files(spark, str(storage)).select("file_name", "profile_id")))
    assert [r[0] for r in got] == ["000003.log", "000005.ldb"]
    assert all(r[1].endswith("/Default") for r in got)


def test_oversized_saved_tab_files_are_left_out(spark, tmp_path, monkeypatch):
    from pagetrail.sources import saved_tab_files as source

    monkeypatch.setattr(source, "MAX_FILE_BYTES", 10)
    (tmp_path / "000001.ldb").write_bytes(b"x" * 11)
    (tmp_path / "000002.ldb").write_bytes(b"x" * 10)
    assert [r.file_name for r in source.saved_tab_files(spark, str(tmp_path)).collect()] == ["000002.ldb"]
    assert [r.length for r in source.oversized_files(spark, str(tmp_path)).collect()] == [11]
