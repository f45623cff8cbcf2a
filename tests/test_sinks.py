import pytest
from rows import tuples

from pagetrail.operators import summary
from pagetrail.sinks import text
from pagetrail.schemas import FIREFOX


@pytest.fixture
def report(spark):
    return spark.createDataFrame([("a\tb,c", None, 1.5, 7), ("q\"x", "two\nlines", 12345678.9, None)], "title string, u string, d double, n int")


def test_raw_lines(report):
    assert [r.line for r in text.raw_lines(report).collect()] == ["a\tb,c\t\t1.5\t7", "q\"x\ttwo\nlines\t12345678.9\t"]
    cleaned = text.raw_lines(report, "csv", clean=("title",)).collect()
    assert cleaned[0].line == "a\tb c,,1.5,7"
    assert [r.line for r in text.with_header(report, "csv").collect()][0] == "title,u,d,n"


def test_unknown_format(report):
    with pytest.raises(ValueError):
        text.raw_lines(report, "json")


@pytest.mark.parametrize("fmt,sep", [("tsv", "\t"), ("csv", ",")])
def test_quoted_files_read_back(spark, report, tmp_path, fmt, sep):
    text.write_report(report, f"{tmp_path}/out", fmt)
    reader = spark.read.option("sep", sep).option("header", True).option("escape", '"').option("multiLine", True)
    back = reader.schema(report.schema).csv(f"{tmp_path}/out")
    assert sorted(map(str, tuples(back))) == sorted(map(str, tuples(report)))


def test_blanks_at_the_ends_of_fields_are_kept(spark, tmp_path):
    odd = spark.createDataFrame([(" a ", "b\t"), ("  ", " \"q\" ")], "title string, url string")
    text.write_report(odd, f"{tmp_path}/out", "csv")
    back = spark.read.option("header", True).option("escape", '"').schema(odd.schema).csv(f"{tmp_path}/out")
    assert sorted(tuples(back)) == sorted(tuples(odd))


def test_raw_file_starts_with_header(spark, report, tmp_path):
    text.write_report(report.limit(1), f"{tmp_path}/raw", "tsv", raw=True)
    lines = [r.value for r in spark.read.text(f"{tmp_path}/raw").collect()]
    assert sorted(lines) == sorted(["title\tu\td\tn", "a\tb,c\t\t1.5\t7"])


def test_summary_text(table):
    tables = {
        "moz_places": table(FIREFOX, "moz_places", [("p", 1, "https://a.example/x", None, 1, 0)]),
        "moz_historyvisits": table(FIREFOX, "moz_historyvisits", [("p", i, 0, 1, 1704067200000000, i % 2) for i in range(3)]),
    }
    dates = {"date_from": "2024-01-01", "date_to": "2024-01-01"}
    lines = text.summary_lines(summary.summary(tables, "firefox", **dates), "firefox", **dates)
    assert [r.line for r in lines.collect()] == [
        "=== Firefox History Summary ===",
        "From: 2024-01-01",
        "To: 2024-01-01",
        "",
        "--- Basic Stats ---",
        "Total visits:    3",
        "Unique URLs:     1",
        "",
        "--- Top 10 Domains ---",
        "  a.example                                3 visits",
        "",
        "--- Visit Types ---",
        "  OTHER                2",
        "  LINK                 1",
    ]
