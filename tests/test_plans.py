"""The physical plans the reports are designed for."""

import re

import pytest

from pagetrail.operators import chromium, firefox, safari, saved_tabs, summary
from pagetrail.plans import newest
from workload import fixtures

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Chromium tables as flat Parquet, visits clustered by time into several row groups."""
    out = tmp_path_factory.mktemp("landed")
    for name, frame in fixtures.chromium(spark, SF).items():
        if name == "visits":
            frame = frame.repartitionByRange(8, "visit_time")
        frame.write.parquet(f"{out}/{name}")
    return {name: spark.read.parquet(f"{out}/{name}") for name in fixtures.chromium(spark, SF)}


def test_date_bounds_reach_the_scan(landed):
    text = plan(chromium.visits(landed, "2024-01-05", "2024-01-06"))
    pushed = re.findall(r"PushedFilters: \[([^\n]*?)\], ReadSchema", text)
    assert any("GreaterThanOrEqual(visit_time,133488864" in p and "LessThan(visit_time,133490592" in p for p in pushed)


def test_short_reports_sort_only_their_top(landed):
    for frame in (chromium.urls(landed), chromium.downloads(landed), chromium.visits(landed), chromium.contexts(landed)):
        text = plan(frame)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_scans_read_only_needed_columns(landed):
    text = plan(summary.domains(landed, "chrome"))
    assert set(re.findall(r"ReadSchema: struct<([^>\n]*)>", text)) == {
        "profile_id:string,url:bigint",
        "profile_id:string,id:bigint,url:string",
    }


def test_gate_closes_the_full_join_in_the_scan(landed):
    frame = chromium.visits(landed, limit=10)
    frame.collect()
    text = plan(frame).split("== Initial Plan ==")[0]
    assert "GreaterThanOrEqual(url,ScalarSubquery" in plan(frame) and "SortMergeJoin" not in text


def test_no_python_in_reports(spark, landed):
    fox, apple = fixtures.firefox(spark, SF), fixtures.safari(spark, SF)
    frames = [
        chromium.visits(landed), chromium.visits(landed, limit=-1), chromium.searches(landed), chromium.annotations(landed),
        firefox.visits(fox), firefox.bookmarks(fox), safari.urls(apple), safari.visits(apple), safari.visits(apple, limit=-1),
        summary.summary(landed, "chrome"), saved_tabs.saved_tabs(fixtures.saved_tab_files(spark, SF)),
    ]
    for frame in frames:
        assert not re.search(r"EvalPython|MapInArrow|MapInPandas|FlatMapGroups|CartesianProduct|BroadcastNestedLoop", plan(frame))


def test_summary_scans_visits_once(landed):
    text = plan(summary.summary(landed, "chrome"))
    assert len(re.findall(r"FileScan parquet \[profile_id[^\]]*visit_duration", text)) == 1
    assert "WindowGroupLimit" in text


def test_saved_tabs_never_shuffle_file_contents(spark, tmp_path):
    fixtures.saved_tab_files(spark, SF).write.parquet(f"{tmp_path}/files")
    frame = saved_tabs.saved_tabs(spark.read.parquet(f"{tmp_path}/files"))
    for exchange in re.split(r"\n", plan(frame)):
        assert not ("Exchange" in exchange and "content" in exchange)
    lines = plan(frame).split("\n")
    for i, line in enumerate(lines):
        if "Exchange" in line and i + 1 < len(lines):
            assert "FileScan" not in lines[i + 1] or "content" not in lines[i + 1]


def test_full_join_splits_a_hot_page(spark):
    """Half of the visits are to one page: AQE must split that partition, and no row may be lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        visits = spark.range(0, 40_000, 1, 8).selectExpr(
            "'p' AS profile_id", "id", "if(id % 2 = 0, 3, id % 5000) AS url", "13348540800000000 + id AS visit_time",
            "if(id % 3 = 0, 0, id - 1) AS from_visit", "id % 12 AS transition", "id AS visit_duration",
        )
        urls = spark.range(5000).selectExpr("'p' AS profile_id", "id", "concat('https://', id, '/') AS url", "'t' AS title")
        frame = chromium.visits({"visits": visits, "urls": urls}, limit=-1)
        assert len(frame.collect()) == 40_000
        assert "skew=true" in plan(frame)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_broadcast_reach_is_bounded():
    assert not newest.is_cut(-1) and newest.is_cut(0) and newest.is_cut(10**9)


def test_rows_without_a_time_meet_by_steps(spark, landed):
    """The first rows of all tasks meet in some tasks before those of these meet in one."""
    fox, apple = fixtures.firefox(spark, SF), fixtures.safari(spark, SF)
    for frame in (firefox.searches(fox), safari.urls(apple)):
        text = plan(frame)
        assert "WindowGroupLimit" in text and "SPARK_PARTITION_ID" in text
    rows = spark.range(0, 5000, 1, 16).selectExpr("id % 7 AS score", "id")
    order = [newest.F.desc("score"), newest.F.asc("id")]
    assert newest.merged_first_rows(rows, order, 30).collect() == rows.orderBy(*order).limit(30).collect()
    assert newest.merged_first_rows(rows, order, 0).collect() == []


def test_searches_shuffle_no_table(landed):
    frame = chromium.searches(landed, limit=10)
    frame.collect()
    text = plan(frame).split("== Initial Plan ==")[0]
    assert "GreaterThanOrEqual(last_visit_time,ScalarSubquery" in plan(frame) and "SortMergeJoin" not in text
