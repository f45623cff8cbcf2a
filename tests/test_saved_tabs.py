import pytest
from rows import tuples

from pagetrail.operators.saved_tabs import grouped_tabs, saved_tabs
from pagetrail.schemas import SAVED_TAB_FILES

DATE = 1704067200123
SHOWN = "2024-01-01 00:00:00"


@pytest.fixture
def files(spark):
    def make(*contents, profile="p"):
        rows = [(profile, name, c if isinstance(c, bytes) else c.encode()) for name, c in contents]
        return spark.createDataFrame(rows, SAVED_TAB_FILES)

    return make


def group(*tabs, date=DATE, comma=","):
    return f'[{",".join(tabs)}]{comma}"createDate":{date}'


def tab(url, title="t"):
    return f'{{"id":"x","url":"{url}","title":"{title}"}}'


def pair(url, title="t"):
    return f'"url":"{url}","title":"{title}"'


def test_groups_and_escapes(files):
    escaped = group(tab("https://a/"), tab("https://b/", "two")).replace('"', '\\"')
    got = tuples(saved_tabs(files(("1.ldb", "\x01junk" + escaped + "}}" + group('{"url":"https://c/"}', comma="")))))
    assert got == [("https://a/", "t", SHOWN), ("https://b/", "two", SHOWN), ("https://c/", "", SHOWN)]


def test_unreadable_groups_yield_nothing(files):
    bad = [
        group('{"url":"https://a/","title":"x]y"}'),
        group('{"url":"https://b/","title":}'),
        group("{'url':'https://c/'}"),
        group('{"url":"https://d/","title":"a\x01b"}'),
        group(tab("https://e/"), date=253402300800000),
        group(tab("https://f/"), date=10**30),
        group('{"url":""}', '{"title":"no url"}', '{"url":null}'),
    ]
    assert tuples(grouped_tabs(files(*[(f"{i}.ldb", b) for i, b in enumerate(bad)]))) == []


def test_null_title_and_last_date(files):
    got = tuples(saved_tabs(files(("1.ldb", group('{"url":"https://a/","title":null}', date=253402300799999)))))
    assert got == [("https://a/", "", "9999-12-31 23:59:59")]


def test_loose_pairs_only_before_the_first_group(files):
    made = files(
        ("1.log", pair("https://early/") + "zz" + pair("ftp://no/")),
        ("2.ldb", pair("https://same/") + group(tab("https://g/"))),
        ("3.ldb", pair("https://late/")),
    )
    assert tuples(saved_tabs(made)) == [("https://early/", "t", ""), ("https://g/", "t", SHOWN)]


def test_profiles_are_gated_separately(files):
    both = files(("1.ldb", group(tab("https://g/"))), profile="a").union(files(("9.ldb", pair("https://l/")), profile="b"))
    assert tuples(saved_tabs(both)) == [("https://g/", "t", SHOWN), ("https://l/", "t", "")]


def test_first_copy_wins_even_when_unreadable(files):
    made = files(
        ("1.ldb", group(tab("https://x/", "T" * 501), tab("https://y/", "T" * 500))),
        ("2.ldb", group(tab("https://x/", "fine"), tab("https://y/", "later"))),
    )
    assert [(r[0], len(r[1])) for r in tuples(saved_tabs(made))] == [("https://y/", 500)]


def test_invalid_bytes_and_control_characters(files):
    loose = b'"url":"https://a/","title":"bad\xffbyte"' + pair("https://b/", "ta\tb").encode()
    loose += pair("https://c/", "c\x01é\U0001f600d").encode() + b'"url":"https://d/\x02","title":"x"'
    loose += pair("https://e/", "\U0001f600 kept").encode()
    got = tuples(saved_tabs(files(("1.log", loose))))
    # A title with a control character loses everything unprintable; a tab alone is left alone.
    assert got == [("https://b/", "ta\tb", ""), ("https://c/", "céd", ""), ("https://e/", "\U0001f600 kept", "")]


@pytest.mark.parametrize("raw", [b"\xff", b"\xc3(", b"\xe2\x82", b"\xf0\x9f\x98", b"\xed\xa0\x80", b"\xc0\xaf", b"a\x80\x80b", b"\xf5\x80\x80\x80"])
def test_replacement_matches_python(files, raw):
    content = b'"url":"https://a/' + raw + b'","title":"t"'
    assert tuples(saved_tabs(files(("1.log", content)))) == [("https://a/" + raw.decode("utf-8", "replace"), "t", "")]


def test_limit(files):
    made = files(("1.ldb", group(*(tab(f"https://{i}/") for i in range(12)))))
    assert [r[0] for r in tuples(saved_tabs(made, 3))] == ["https://0/", "https://1/", "https://2/"]
    assert len(tuples(saved_tabs(made, 0))) == len(tuples(saved_tabs(made, -4))) == 12


def test_many_tabs_in_one_group(files):
    tabs = group(*(tab(f"https://{i}/", "x" * 60) for i in range(20_000)))
    whole = saved_tabs(files(("1.ldb", tabs)), 0)
    assert [(r.group_date, r["count"]) for r in whole.groupBy("group_date").count().collect()] == [(SHOWN, 20_000)]
    # A stray "[{" opens the match and spoils the JSON, so the pairs are taken without a date.
    spoiled = saved_tabs(files(("1.ldb", "[{" * 3 + tabs)), 0)
    assert [(r.group_date, r["count"]) for r in spoiled.groupBy("group_date").count().collect()] == [("", 20_000)]


def test_files_are_searched_once(spark, tmp_path):
    from workload import fixtures

    fixtures.odd_tab_files(spark, "/root/testdata/sf0.01").write.parquet(f"{tmp_path}/files")
    frame = saved_tabs(spark.read.parquet(f"{tmp_path}/files"), 0)
    assert frame.count() == 86
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
