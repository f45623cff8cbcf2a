"""Summaries from daily counts, leading domains, distinct pages as bits."""

import random

import pytest
from pyspark.sql import functions as F
from rows import tuples

from pagetrail.functions.timecodec import CHROMIUM_TIME, FIREFOX_TIME, SAFARI_TIME
from pagetrail.operators import rollup, summary
from pagetrail.schemas import CHROMIUM, SAFARI
from workload import fixtures

SF = "/root/testdata/sf0.001"
MAKE = {"chrome": fixtures.chromium, "edge": fixtures.edge, "firefox": fixtures.firefox, "safari": fixtures.safari}
RANGES = [
    {},
    {"date_from": "2024-01-08", "date_to": "2024-01-14"},
    {"date_from": "2024-01-08", "tz": "America/New_York"},
    {"date_to": "2024-01-09", "tz": "Asia/Kolkata"},
    {"date_from": "2024-01-10", "date_to": "2024-01-10", "tz": "America/New_York"},  # no whole UTC day
    {"date_from": "1999-01-01", "date_to": "1999-01-02"},
]


@pytest.mark.parametrize("browser", MAKE)
def test_equal_to_the_summary(spark, browser, tmp_path):
    tables = MAKE[browser](spark, SF)
    rollup.keep_daily(rollup.daily(tables, browser), browser, str(tmp_path))
    counts = rollup.kept_daily(spark, browser, str(tmp_path))
    for dates in RANGES:
        assert tuples(rollup.summary(counts, tables, browser, **dates)) == tuples(summary.summary(tables, browser, **dates))


def test_counts_of_parts_are_put_together(spark, table):
    rng = random.Random(3)
    day = 86_400_000_000
    base = 13348540800000000
    rows = [("p", i, rng.randrange(5), rng.choice([None, 0, -1, base - 1, base, base + day - 1, base + day]), 0, rng.choice([None, 1, 8]), i) for i in range(300)]
    urls = table(CHROMIUM, "urls", [("p", i, f"https://{i}/", "t", 1, 1, 0) for i in range(4)])
    whole = {"visits": table(CHROMIUM, "visits", rows), "urls": urls}
    parts = [rollup.daily({"visits": table(CHROMIUM, "visits", rows[n::3])}, "chrome") for n in range(3)]
    counts = rollup.put_together("chrome", *parts)
    assert sorted(tuples(counts), key=str) == sorted(tuples(rollup.daily(whole, "chrome")), key=str)
    for dates in RANGES + [{"date_from": "2024-01-01", "date_to": "2024-01-01"}]:
        assert tuples(rollup.summary(counts, whole, "chrome", **dates)) == tuples(summary.summary(whole, "chrome", **dates))


@pytest.mark.parametrize("encoding", [CHROMIUM_TIME, FIREFOX_TIME, SAFARI_TIME])
def test_days_are_exact_at_midnight(spark, encoding):
    units = 86_400 * encoding.units
    step = 1e-7 if encoding.real else 1
    days = [-3, -1, 0, 1, 8400, 8401, 19723, 154498]
    times = [(d, d * units + s) for d in days for s in (0, units // 2, units - step)]
    kind = "double" if encoding.real else "bigint"
    frame = spark.createDataFrame([(d, float(t) if encoding.real else int(t)) for d, t in times], f"d bigint, t {kind}")
    exact = frame.where(rollup.day_of(F.col("t"), encoding) != F.expr(f"CASE WHEN t >= (d + 1) * {units} THEN d + 1 ELSE d END"))
    assert exact.collect() == []


def test_a_range_reads_its_months_only(spark, tmp_path):
    tables = fixtures.chromium(spark, SF)
    rollup.keep_daily(rollup.daily(tables, "chrome"), "chrome", str(tmp_path))
    counts = rollup.kept_daily(spark, "chrome", str(tmp_path))
    text = rollup.summary(counts, tables, "chrome", "2024-01-08", "2024-01-14")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day,154504)" in text and "LessThan(day,154511)" in text


def plain_domains(rows, limit):
    sums = {}
    for name, n in rows:
        sums[name] = sums.get(name, 0) + n
    return sorted(sums.items(), key=lambda r: (-r[1], r[0] is not None, r[0] or ""))[:limit]


@pytest.mark.parametrize("limit", [1, 10, 500])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_leading_domains_with_ties(spark, monkeypatch, limit, seed):
    monkeypatch.setattr(summary, "SLOTS", 64)
    rng = random.Random(seed)
    rows = [(rng.choice([None, "", *(f"d{i}" for i in range(200))]), rng.randrange(1, 4)) for _ in range(600)]
    rows += [(f"top{i}", 40 + i // 4) for i in range(12)]
    found = summary.possible_domains(spark.createDataFrame(rows, "domain string, n bigint"), limit)
    order = [F.desc("cnt"), F.asc_nulls_first("domain")]
    assert tuples(found.orderBy(*order).limit(limit)) == plain_domains(rows, limit)


def test_few_domains_are_counted_one_by_one(spark):
    """Of 100,000 domains the last shuffle sees those of a few slots."""
    rows = spark.range(100_000).selectExpr("concat('d', id) AS domain", "if(id < 20, 1000 + id, 1) AS n")
    found = summary.possible_domains(rows, 10)
    assert found.count() < 100
    assert [r.cnt for r in found.orderBy(F.desc("cnt")).limit(10).collect()] == list(range(1019, 1009, -1))


def test_pages_as_bits(spark, table):
    rng = random.Random(9)
    pages = [rng.choice([None, 0, 1, 63, 64, 65, -1, -64, -65, 2**62, -(2**63), 2**63 - 1, rng.randrange(300)]) for _ in range(900)]
    rows = [(rng.choice(["a", "b"]), i, page, 13348540800000000, 0, 1, 7) for i, page in enumerate(pages)]
    tables = {"visits": table(CHROMIUM, "visits", rows)}
    distinct = {(p, page) for p, _, page, *_ in rows if page is not None}
    assert tuples(summary.basic(tables, "chrome").select("total_visits", "unique_urls")) == [(900, len(distinct))]
    per = {r.profile_id: (r.total_visits, r.unique_urls) for r in summary.basic(tables, "chrome", per_profile=True).collect()}
    assert per == {p: (sum(r[0] == p for r in rows), sum(d[0] == p for d in distinct)) for p in "ab"}
    none = {"history_visits": table(SAFARI, "history_visits", [])}
    assert tuples(summary.basic(none, "safari")) == [(0, 0)]


def test_words_are_fewer_than_pages(spark):
    """10,000 pages of a profile meet as 157 words."""
    visits = spark.range(0, 40_000, 1, 4).selectExpr(
        "'p' AS profile_id", "id", "id % 10000 AS url", "13348540800000000 + id AS visit_time", "0L AS from_visit", "1L AS transition", "1L AS visit_duration"
    )
    frame = summary.basic({"visits": visits}, "chrome")
    assert tuples(frame.select("unique_urls")) == [(10_000,)]
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "shiftright(page" in text and "Expand" not in text and "SortAggregate" not in text.split("Initial Plan")[0]
