"""Report semantics on small tables with two profiles that reuse the same ids."""

import random

import pytest
from rows import tuples
from pyspark.sql import functions as F

from pagetrail.operators import chromium, firefox, safari, summary
from pagetrail.plans import newest
from pagetrail.schemas import CHROMIUM, FIREFOX, SAFARI
from workload import fixtures

DAY = 86_400_000_000
BASE = 13348540800000000  # 2024-01-01 UTC


@pytest.fixture(params=["short", "full"])
def path(request, monkeypatch):
    """Run a test once with the scan-only plan and once with whole-table joins."""
    if request.param == "full":
        for module in (chromium, firefox, safari):
            monkeypatch.setattr(module, "is_cut", lambda limit, per_profile=False: False)
    return request.param


@pytest.fixture(scope="module")
def chrome(table):
    rng = random.Random(7)
    profiles = ("a", "b")
    urls = [(p, i, f"https://{p}{i}.x/", None if i == 3 else f"t{p}{i}", i, i % 2, BASE + i) for p in profiles for i in range(1, 9)]
    visits = [
        (p, i, rng.randrange(1, 11), BASE + rng.randrange(50) * DAY // 5, rng.choice([0, 0, 999, None, *range(1, 60)]),
         rng.choice([None, 1, 805306368 + 11]), rng.randrange(10_000_000))
        for p in profiles for i in range(0, 60)
    ]
    terms = [(p, f"q{i}", rng.randrange(1, 11)) for p in profiles for i in range(30)]
    notes = [(p, v, None, "en", f"s{v}") for p in profiles for v in range(0, 60, 2)]
    contexts = [(p, v, -1_000_000 if v % 4 else 50_000, 200, v, None) for p in profiles for v in range(0, 90, 3)]
    downloads = [(p, i, f"f{i}", i, "", i, BASE + i % 3, None, "r") for p in profiles for i in range(6)]
    raw = {"urls": urls, "visits": visits, "keyword_search_terms": terms, "content_annotations": notes,
           "context_annotations": contexts, "downloads": downloads}
    return {"rows": raw, "tables": {name: table(CHROMIUM, name, rows) for name, rows in raw.items()}}


def expected_visits(raw):
    urls = {(u[0], u[1]): u for u in raw["urls"]}
    visits = {(v[0], v[1]): v for v in raw["visits"]}
    out = []
    for p, i, page, t, source, *_ in raw["visits"]:
        if (p, page) in urls:
            hop = visits.get((p, source))
            from_url = urls.get((p, hop[2]), (None, None, ""))[2] if hop else ""
            out.append(((-t, p, page, i), urls[p, page][2], from_url))
    return [(url, from_url) for _, url, from_url in sorted(out)]


@pytest.mark.parametrize("limit", [0, 1, 7, 100, -1])
def test_chromium_visits(chrome, path, limit):
    want = expected_visits(chrome["rows"])
    got = [(r.url, r.from_url) for r in chromium.visits(chrome["tables"], limit=limit).collect()]
    assert got == (want if limit < 0 else want[:limit])


def test_visit_id_zero_is_found_through_the_salts(chrome, path):
    # Visit 0 exists here, so a referrer of 0 is a real link for its profile.
    linked = {p for p, i, page, *_ in chrome["rows"]["visits"] if i == 0 and page <= 8}
    rows = chromium.visits(chrome["tables"], limit=-1).collect()
    zero = [v for v in chrome["rows"]["visits"] if v[4] == 0 and v[0] in linked and v[2] <= 8]
    assert len([r for r in rows if r.from_url]) >= len(zero)


def test_chromium_searches(chrome, path):
    urls = {(u[0], u[1]): u for u in chrome["rows"]["urls"]}
    want = sorted((-urls[p, u][6], p, u, term) for p, term, u in chrome["rows"]["keyword_search_terms"] if (p, u) in urls)
    got = [(r.term, r.url) for r in chromium.searches(chrome["tables"], limit=12).collect()]
    assert got == [(term, urls[p, u][2]) for _, p, u, term in want[:12]]


def test_chromium_annotations_and_contexts(chrome, path):
    urls = {(u[0], u[1]) for u in chrome["rows"]["urls"]}
    visits = {(v[0], v[1]): v for v in chrome["rows"]["visits"]}

    def order(rows):
        keys = [(n[0], n[1]) for n in rows if (n[0], n[1]) in visits and (n[0], visits[n[0], n[1]][2]) in urls]
        return sorted(keys, key=lambda k: (-visits[k][3], k[0], visits[k][2], k[1]))

    got = [r.search_terms for r in chromium.annotations(chrome["tables"], limit=15).collect()]
    assert got == [f"s{v}" for _, v in order(chrome["rows"]["content_annotations"])[:15]]
    rows = chromium.contexts(chrome["tables"], limit=15).collect()
    assert [r.tab_id for r in rows] == [v for _, v in order(chrome["rows"]["context_annotations"])[:15]]
    assert {r.foreground_sec for r in rows} <= {-1.0, 0.1}


def test_downloads_order_by_shown_second(table):
    rows = [("p", i, f"f{i}", 1, None, 9, BASE + us, None, None) for i, us in enumerate([5, 999_999, 1_000_000, 7, 7])]
    got = tuples(chromium.downloads({"downloads": table(CHROMIUM, "downloads", rows)}))
    assert [r[0] for r in got] == ["f2", "f1", "f3", "f4", "f0"]
    assert got[0][3] == "UNKNOWN(9)" and got[0][5:] == ("", "")


def test_downloads_in_the_repeated_hour(table):
    first, second = 1730611800, 1730613600  # 01:30 EDT, then 01:00 EST: the later one shows an earlier clock
    rows = [("p", i, f"f{i}", 1, "", 1, (s + 11644473600) * 10**6, "", "") for i, s in enumerate([first, second])]
    frame = table(CHROMIUM, "downloads", rows)
    assert [r[0] for r in tuples(chromium.downloads({"downloads": frame}, tz="America/New_York"))] == ["f0", "f1"]
    assert [r[0] for r in tuples(chromium.downloads({"downloads": frame}))] == ["f1", "f0"]


def test_mostly_dangling_rows_open_the_full_branch(spark):
    """More dangling rows on top than the quick branch reaches: the answer must still be exact."""
    n = newest.reach_of(5) + 500
    visits = spark.range(n).selectExpr(
        "'p' AS profile_id", "id + 1 AS id", f"if(id < 100, 1L, 77L) AS url", f"{BASE} + id AS visit_time",
        "0L AS from_visit", "1L AS transition", "0L AS visit_duration",
    )
    urls = spark.sql(f"SELECT 'p' AS profile_id, 1L AS id, 'u' AS url, 't' AS title, 1L AS visit_count, 1L AS typed_count, {BASE} AS last_visit_time")
    got = chromium.visits({"visits": visits, "urls": urls}, limit=5)
    assert [r.url for r in got.collect()] == ["u"] * 5
    some = chromium.visits({"visits": visits, "urls": urls}, limit=200)
    assert some.count() == 100


def test_limits_are_checked(chrome):
    for bad in ("5", 2.0, True, None):
        with pytest.raises(TypeError):
            chromium.visits(chrome["tables"], limit=bad)


def test_longer_limit_extends_shorter(chrome):
    short = tuples(chromium.visits(chrome["tables"], limit=10))
    assert tuples(chromium.visits(chrome["tables"], limit=25))[:10] == short


def test_wider_range_keeps_rows(chrome):
    narrow = tuples(chromium.visits(chrome["tables"], "2024-01-03", "2024-01-04", -1))
    wide = tuples(chromium.visits(chrome["tables"], "2024-01-02", "2024-01-06", -1))
    assert narrow and set(narrow) <= set(wide) and len(narrow) < len(wide)


@pytest.fixture(scope="module")
def fox(table):
    places = [("a", 1, "https://u1/", None, 2, 50), ("a", 2, "https://u2/", "t2", 0, 60), ("a", 3, "https://u3/", "t3", 1, None),
              ("b", 1, "https://v1/", "s1", 1, 55)]
    visits = [("a", 1, 0, 1, 10, 1), ("a", 2, 1, 3, 30, None), ("a", 3, 2, 9, 40, 2), ("b", 2, 1, 1, 20, 11)]
    inputs = [("a", 1, "x", 0.5), ("a", 3, "y", 2.0), ("a", 9, "z", 9.0), ("b", 1, "w", 2.0)]
    marks = [("a", 1, 2, None, 0, "folder", 1), ("a", 2, 1, 1, 1, None, 5), ("a", 3, 1, None, 99, "m3", 7), ("a", 4, 3, None, 1, "sep", 9),
             ("b", 1, 1, 1, 2, "m1", 6)]
    return {"moz_places": table(FIREFOX, "moz_places", places), "moz_historyvisits": table(FIREFOX, "moz_historyvisits", visits),
            "moz_inputhistory": table(FIREFOX, "moz_inputhistory", inputs), "moz_bookmarks": table(FIREFOX, "moz_bookmarks", marks)}


def test_firefox_urls(fox):
    epoch = "1970-01-01 00:00:00"
    want = [("https://v1/", "s1", 1, epoch), ("https://u1/", "", 2, epoch), ("https://u3/", "t3", 1, None)]
    assert tuples(firefox.urls(fox)) == want
    assert len(tuples(firefox.urls(fox, date_from="1970-01-01"))) == 2


def test_firefox_visits(fox, path):
    got = [(r.url, r.title, r.transition, r.from_url) for r in firefox.visits(fox, limit=5).collect()]
    assert got == [("https://u3/", "t3", None, "https://u1/"), ("https://v1/", "s1", "OTHER(11)", ""), ("https://u1/", "", "LINK", "")]


def test_firefox_searches(fox, path):
    got = [(r.input, r.url, r.use_count) for r in firefox.searches(fox, limit=2).collect()]
    assert got == [("y", "https://u3/", 2.0), ("w", "https://v1/", 2.0)]


def test_firefox_bookmarks(fox, path):
    got = [(r.title, r.url, r.parent_title) for r in firefox.bookmarks(fox, limit=9).collect()]
    assert got == [("m3", "", ""), ("m1", "https://v1/", ""), (None, "https://u1/", "folder")]


@pytest.fixture(scope="module")
def apple(table):
    items = [("a", 1, "https://i1/", 3, 100.0), ("a", 2, "https://i2/", 1, 300.0), ("a", 3, "https://i3/", 0, 900.0), ("b", 1, "https://j1/", 1, 200.0)]
    visits = [("a", 1, 1, 10.0, "old", 0, 2), ("a", 2, 1, 20.5, "", 1, 77), ("a", 3, 2, 86_400.0, None, 2, None),
              ("a", 4, 1, 15.0, "new", None, None), ("b", 2, 1, 20.5, "jt", 4, 2), ("a", 5, 9, 50.0, "gone", 1, 1)]
    return {"history_items": table(SAFARI, "history_items", items), "history_visits": table(SAFARI, "history_visits", visits)}


def test_safari_urls(apple, path):
    got = [(r.url, r.title) for r in safari.urls(apple, limit=9).collect()]
    assert got == [("https://i2/", ""), ("https://j1/", "jt"), ("https://i1/", "new")]
    ranged = [r.url for r in safari.urls(apple, "2001-01-01", "2001-01-01", 9).collect()]
    assert ranged == ["https://j1/", "https://i1/"]
    real = [r.url for r in safari.urls(apple, limit=9, last_visit="max_visit_time").collect()]
    assert real == ["https://i2/", "https://i1/", "https://j1/"]
    with pytest.raises(ValueError):
        safari.urls(apple, last_visit="guess")


def test_safari_visits(apple, path):
    got = [(r.url, r.title, r.redirect_source, r.redirect_destination) for r in safari.visits(apple, limit=9).collect()]
    assert got == [
        ("https://i2/", "", "https://i1/", ""),
        ("https://i1/", "", "https://i1/", ""),
        ("https://j1/", "jt", "", "https://j1/"),
        ("https://i1/", "new", "", ""),
        ("https://i1/", "old", "", "https://i1/"),
    ]


def test_summary_sections_agree_with_single_reports(chrome):
    tables = chrome["tables"]
    long_form = tuples(summary.summary(tables, "chrome"))
    part = lambda name: [(r[2], r[3]) for r in long_form if r[0] == name]
    basic = summary.basic(tables, "chrome").first()
    assert part("basic")[:2] == [("total_visits", str(basic.total_visits)), ("unique_urls", str(basic.unique_urls))]
    assert part("domains") == [(r.domain, str(r.cnt)) for r in summary.domains(tables, "chrome").collect()]
    assert part("types") == [(r.type, str(r.cnt)) for r in summary.types(tables, "chrome").collect()]
    assert sum(int(n) for _, n in part("types")) == basic.total_visits == 120
    assert sum(r.cnt for r in summary.domains(tables, "chrome").collect()) <= basic.total_visits


def test_domain_ties_at_the_cut_are_broken_by_name(table):
    urls = [("p", i, f"https://d{i:02}/", None, 1, 1, BASE) for i in range(1, 15)] + [("p", 20, None, None, 1, 1, BASE)]
    visits = [("p", i, i, BASE, 0, 0, 0) for i in range(1, 15)] + [("p", 30, 20, BASE, 0, 0, 0), ("p", 31, 14, BASE, 0, 0, 0)]
    tables = {"urls": table(CHROMIUM, "urls", urls), "visits": table(CHROMIUM, "visits", visits)}
    want = ["d14", None, *(f"d{i:02}" for i in range(1, 9))]
    assert [r.domain for r in summary.domains(tables, "edge").collect()] == want
    assert [r.key for r in summary.summary(tables, "edge").where("section = 'domains'").collect()] == want


def test_summary_of_nothing(chrome):
    got = tuples(summary.summary(chrome["tables"], "chrome", "1990-01-01", "1990-01-02"))
    assert got == [("basic", 1, "total_visits", "0"), ("basic", 2, "unique_urls", "0"), ("basic", 3, "total_hours", None)]
    assert tuples(summary.basic(chrome["tables"], "chrome", "1990-01-01", "1990-01-02")) == [(0, 0, None)]


def test_edge_and_safari_have_no_types(chrome):
    for browser in ("edge", "safari"):
        with pytest.raises(ValueError):
            summary.types(chrome["tables"], browser)


@pytest.mark.parametrize("limit", [1, 2, 4, 100, 10_000, 10_001, 60_000, -1])
def test_repeated_notes_join_as_often_as_they_are_there(table, limit):
    visits = [("a", i, 1, BASE + i, 0, 0, 0) for i in range(1, 4)]
    tables = {
        "urls": table(CHROMIUM, "urls", [("a", 1, "https://x/", "t", 1, 0, BASE)]),
        "visits": table(CHROMIUM, "visits", visits),
        "content_annotations": table(
            CHROMIUM, "content_annotations", [("a", i, c, "en", None) for i, c in [(3, "p"), (3, "q"), (3, "r"), (1, "s")]]
        ),
    }
    found = chromium.annotations(tables, limit=limit).collect()
    times = [r.visit_time for r in found]
    assert len(found) == (4 if limit < 0 else min(limit, 4)) and times == sorted(times, reverse=True)
    assert len(set(found)) == len(found)


@pytest.mark.parametrize("limit", [0, 3, -1])
def test_a_report_per_profile_is_the_report_of_each_profile(spark, chrome, limit):
    def both(tables):
        return {n: tables[n].unionByName(tables[n].withColumn("profile_id", F.lit("p1"))) for n in tables}

    sf = "/root/testdata/sf0.001"
    fox, apple = both(fixtures.firefox(spark, sf)), both(fixtures.safari(spark, sf))
    reports = [(chrome["tables"], r, "a") for r in (chromium.urls, chromium.visits, chromium.searches, chromium.annotations)]
    reports += [(chrome["tables"], r, "b") for r in (chromium.contexts, chromium.downloads)]
    reports += [(fox, r, "p1") for r in (firefox.urls, firefox.visits, firefox.bookmarks, firefox.searches)]
    reports += [(apple, r, "p1") for r in (safari.urls, safari.visits)]
    for tables, report, profile in reports if limit == 3 else reports[:6]:
        alone = {name: t.where(F.col("profile_id") == profile) for name, t in tables.items()}
        got = [r[1:] for r in tuples(report(tables, limit=limit, per_profile=True)) if r[0] == profile]
        assert got == tuples(report(alone, limit=limit)), report


def test_summaries_per_profile(chrome):
    for report in (summary.basic, summary.domains, summary.types):
        every = tuples(report(chrome["tables"], "chrome", per_profile=True))
        for profile in ("a", "b"):
            alone = {name: t.where(F.col("profile_id") == profile) for name, t in chrome["tables"].items()}
            assert [r[1:] for r in every if r[0] == profile] == tuples(report(alone, "chrome")), report
