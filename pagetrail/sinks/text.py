"""Text output: delimited reports and the printed summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.scalars import blank_if_null, real_text
from pagetrail.operators.summary import BASIC, DOMAINS, LAYOUTS, TYPES, in_order

SEPARATORS = {"tsv": "\t", "csv": ","}

# fixed values: the printed forms of a summary
BROWSER_TITLES = {"chrome": "Chrome", "edge": "Edge", "firefox": "Firefox", "safari": "Safari"}
SECTION_TITLES = {BASIC: "Basic Stats", DOMAINS: "Top 10 Domains"}
TOTAL_LINES = {
    "total_visits": "Total visits:    %s",
    "unique_urls": "Unique URLs:     %s",
    "total_hours": "Total duration:  %s hours",
}
DOMAIN_LINE = "  %-40s %s visits"
TYPE_LINE = "  %-20s %s"


def _separator(fmt: str) -> str:
    if fmt not in SEPARATORS:
        raise ValueError(f"format must be one of {sorted(SEPARATORS)}, got {fmt!r}")
    return SEPARATORS[fmt]


def raw_lines(report: DataFrame, fmt: str = "tsv", clean: tuple[str, ...] = ()) -> DataFrame:
    """One unquoted ``line`` per row, NULL as empty text.

    Separators inside the columns named in ``clean`` become spaces (saved-tab titles);
    other fields are copied as they are, so a separator inside one shifts its row.
    """
    sep = _separator(fmt)

    def field(name: str, kind: str) -> Column:
        text = real_text(F.col(name)) if kind in ("double", "float") else F.col(name).cast("string")
        text = F.replace(text, F.lit(sep), F.lit(" ")) if name in clean else text
        return blank_if_null(text)

    return report.select(F.concat_ws(sep, *(field(n, k) for n, k in report.dtypes)).alias("line"))


def header_line(report: DataFrame, fmt: str = "tsv") -> str:
    return _separator(fmt).join(report.columns)


def with_header(report: DataFrame, fmt: str = "tsv", clean: tuple[str, ...] = ()) -> DataFrame:
    """Header line followed by the report's raw lines, in the report's order."""
    header = report.sparkSession.range(1, numPartitions=1).select(F.lit(header_line(report, fmt)).alias("line"))
    return header.unionByName(raw_lines(report, fmt, clean))


def write_report(
    report: DataFrame, path: str, fmt: str = "tsv", raw: bool = False, clean: tuple[str, ...] = ()
) -> None:
    """Write a report with header; fields are quoted where needed unless ``raw``."""
    if raw:
        with_header(report, fmt, clean).write.text(path)
    else:
        # Spark's writer would trim fields.
        as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        report.write.options(sep=_separator(fmt), header=True, escape='"', **as_is).csv(path)


def visit_pairs(visits: DataFrame) -> DataFrame:
    """Time and page of each visit, the two columns usually piped onwards."""
    return visits.select("visit_time", "url")


def visit_count_lines(urls: DataFrame) -> DataFrame:
    """``title (n visits)`` per page."""
    return urls.select(F.format_string("%s (%s visits)", blank_if_null(F.col("title")), "visit_count").alias("line"))


def summary_lines(
    summary: DataFrame, browser: str, date_from: str | None = None, date_to: str | None = None
) -> DataFrame:
    """The printed summary as ``(block, line_no, line)``, ordered by block and line."""
    layout = LAYOUTS[browser]
    sections = [(BASIC, SECTION_TITLES[BASIC]), (DOMAINS, SECTION_TITLES[DOMAINS])]
    if layout.types_title:
        sections.append((TYPES, layout.types_title))
    fixed = [(0, 1, f"=== {BROWSER_TITLES[browser]} History Summary ===")]
    if date_from is not None:
        fixed.append((0, 2, f"From: {date_from}"))
    if date_to is not None:
        fixed.append((0, 3, f"To: {date_to}"))
    for block, (_, title) in enumerate(sections, start=1):
        fixed += [(block, -1, ""), (block, 0, f"--- {title} ---")]
    cells = (
        F.struct(F.lit(block).alias("block"), F.lit(number).alias("line_no"), F.lit(line).alias("line"))
        for block, number, line in fixed
    )
    frame = summary.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*cells)))

    value, key = blank_if_null(F.col("value")), blank_if_null(F.col("key"))
    block, line = F, F
    for number, (section, _) in enumerate(sections, start=1):
        block = block.when(F.col("section") == section, F.lit(number))
    for total, form in TOTAL_LINES.items():
        line = line.when((F.col("section") == BASIC) & (F.col("key") == total), F.format_string(form, value))
    line = line.when(F.col("section") == DOMAINS, F.format_string(DOMAIN_LINE, key, value))
    line = line.otherwise(F.format_string(TYPE_LINE, key, value))
    rows = summary.select(block.alias("block"), F.col("rank").alias("line_no"), line.alias("line"))
    return in_order(frame.unionByName(rows), F.asc("block"), F.asc("line_no"))
