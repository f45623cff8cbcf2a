"""Tables clustered by profile and time: the same rows, from few files."""

import random

import pytest
from pyspark.sql import functions as F
from rows import tuples

from pagetrail.operators import chromium, summary
from pagetrail.schemas import CHROMIUM
from pagetrail.sources import clustered_tables
from pagetrail.sources.clustered_tables import ClusteredTables, clustered_rows

BASE = 13348540800000000
DAY = 86_400_000_000


@pytest.fixture(scope="module")
def fleet(spark, table, tmp_path_factory):
    """60 profiles, one of them with a third of the visits, over 90 days."""
    path = str(tmp_path_factory.mktemp("clustered"))
    rng = random.Random(6)
    profiles = [f"p{n}" for n in range(60)]
    visits = []
    for i in range(12_000):
        profile = "p0" if i % 3 == 0 else rng.choice(profiles)
        time = rng.choice([None, 0, 2**61]) if i % 500 == 0 else BASE + rng.randrange(90 * DAY)
        visits.append((profile, i, i % 9, time, 0, 1, 5))
    urls = [(p, i, f"https://{p}/{i}", "t", 1, 1, BASE) for p in profiles for i in range(8)]
    rows = {"visits": visits, "urls": urls}
    tables = {name: table(CHROMIUM, name, rows.get(name, [])) for name in CHROMIUM}
    clustered_tables.keep_clustered(tables, "chrome", path, file_rows=200)
    return path, tables


def test_all_rows_are_kept(spark, fleet):
    path, tables = fleet
    kept = ClusteredTables(spark, path, "chrome")
    assert len(kept) == len(CHROMIUM) and "visits" in kept and "named_visits" not in kept
    for name in CHROMIUM:
        assert sorted(tuples(kept[name]), key=str) == sorted(tuples(tables[name]), key=str)
    assert tuples(chromium.visits(kept, limit=50)) == tuples(chromium.visits(tables, limit=50))
    assert tuples(summary.basic(kept, "chrome")) == tuples(summary.basic(tables, "chrome"))


@pytest.mark.parametrize("profiles", [["p7"], ["p0", "p31"], ["nobody"], [], None])
@pytest.mark.parametrize("dates", [{}, {"date_from": "2024-02-05", "date_to": "2024-02-11"}, {"date_from": "2024-03-20", "tz": "Asia/Kolkata"}, {"date_to": "1999-01-01"}])
def test_same_rows_as_a_filter(spark, fleet, profiles, dates):
    path, tables = fleet
    got = clustered_rows(spark, path, "chrome", "visits", profiles, **dates)
    whole = clustered_rows(spark, path, "chrome", "visits", None)
    want = tables["visits"] if profiles is None else tables["visits"].where(F.col("profile_id").isin(profiles))
    want = chromium._dated(want, "visit_time", dates.get("date_from"), dates.get("date_to"), dates.get("tz", "UTC"))
    assert sorted(tuples(got), key=str) == sorted(tuples(want), key=str)
    assert len(got.inputFiles()) <= len(whole.inputFiles())


def test_a_profiles_week_is_in_few_files(spark, fleet):
    path, _ = fleet
    every = len(clustered_rows(spark, path, "chrome", "visits").inputFiles())
    week = {"date_from": "2024-02-05", "date_to": "2024-02-11"}
    assert every == 60
    for profile, most in (("p7", 4), ("p0", 6)):
        assert len(clustered_rows(spark, path, "chrome", "visits", [profile], **week).inputFiles()) <= most
    assert len(clustered_rows(spark, path, "chrome", "visits", ["p7"]).inputFiles()) < every / 2
    assert len(clustered_rows(spark, path, "chrome", "visits", None, **week).inputFiles()) < every / 2


def test_a_hot_profile_is_in_many_files(spark, fleet):
    """A third of all rows has one profile; no file is larger for it."""
    path, _ = fleet
    sizes = [r["count"] for r in clustered_rows(spark, path, "chrome", "visits").groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 12_000 and max(sizes) < 700


def test_the_curve_takes_bits_in_turn(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (65535, 65535), (32768, 0), (0, 32768), (3, 1)], "slot bigint, time bigint")
    got = [r[0] for r in rows.select(clustered_tables.curve(F.col("slot"), F.col("time"))).collect()]
    assert got == [0, 2, 1, 2**32 - 1, 2**31, 2**30, 11]


def test_tables_without_a_time(spark, fleet):
    path, _ = fleet
    assert clustered_rows(spark, path, "chrome", "keyword_search_terms", ["p1"]).collect() == []
    with pytest.raises(ValueError, match="no time"):
        clustered_rows(spark, path, "chrome", "keyword_search_terms", ["p1"], date_from="2024-01-01")


@pytest.mark.parametrize("task_rows, file_rows, tasks", [(2000, 50, 4), (300, 200, 30)])
def test_a_task_writes_many_small_files(spark, fleet, tmp_path, monkeypatch, task_rows, file_rows, tasks):
    """What reaches the driver grows with the tasks that write, and these with the rows, not with the files."""
    _, tables = fleet
    few = {name: rows.where("id < 6000") if name == "visits" else rows.limit(0) for name, rows in tables.items()}
    monkeypatch.setattr(clustered_tables, "TASK_ROWS", task_rows)
    clustered_tables.keep_clustered(few, "chrome", str(tmp_path), file_rows)
    kept = clustered_rows(spark, str(tmp_path), "chrome", "visits")
    written = {path.rsplit("/", 1)[1].split("-c")[0] for path in kept.inputFiles()}
    assert tasks - 1 <= len({path.split("-")[1] for path in written}) <= tasks
    sizes = [r["count"] for r in kept.groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 6000 and (task_rows == 300 or max(sizes) <= file_rows)
    week = {"date_from": "2024-02-05", "date_to": "2024-02-11"}
    got = clustered_rows(spark, str(tmp_path), "chrome", "visits", ["p7"], **week)
    want = chromium._dated(few["visits"].where("profile_id = 'p7'"), "visit_time", week["date_from"], week["date_to"], "UTC")
    assert sorted(tuples(got), key=str) == sorted(tuples(want), key=str)
