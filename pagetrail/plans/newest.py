"""Plan shapes for "the first n rows by some order" over keyed history tables.

Reports are N:1 joins followed by ORDER BY ... LIMIT n, and one page may own a third of
all visits. For a small n the reports normally shuffle no table at all:

1. ``recent`` counts rows per hour, reading only the time column, and cuts the table at the
   hour that completes n rows. The cut is a scalar subquery that Parquet pushes down, so the
   other columns are read for the newest row groups only, and the final top-n merge gets
   about n rows instead of n from every one of perhaps a million tasks.
2. ``newest_matched`` takes a few times n of these rows and looks their parents up by
   streaming the parent table past that broadcast handful. If n of them have parents, they
   are the answer. If not (most of the newest rows dangle), a scalar subquery opens a second
   branch that joins the whole tables; otherwise the same subquery, pushed down to Parquet,
   makes that branch skip every row group.
3. ``attach`` / ``fetch`` / ``referrer_urls`` read the wide columns (URL, title) and the
   referrer rows only for the <= n survivors.

The same program serves every limit; past MAX_BROADCAST_ROWS the few rows are joined by their
size at run time instead of being broadcast. Without a limit every row is needed and the reports
join the tables directly; AQE splits skewed join partitions there.

Join keys are listed id first: sort-merge joins then sort by a selective number, not by
the profile text that many rows share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.functions.timecodec import TimeEncoding
from pagetrail.schemas import PROFILE

#: Rows of a profile id and fixed-width numbers that are broadcast at most: a few MB. More are joined by whatever
#: their size at run time suggests; the program is the same.
MAX_BROADCAST_ROWS = 50_000

#: Tasks that merge the first rows of all tasks, and how many rows Spark's window operator cuts in a task at most.
MERGES, MAX_CUT_ROWS = 512, 1000

#: Copies of a sentinel key in a salted join.
SALTS = 64

LOWEST, HIGHEST = -(2**63), 2**63 - 1


def check_limit(limit: int) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int):
        raise TypeError(f"limit must be an int, got {limit!r}")
    return limit


def is_cut(limit: int, per_profile: bool = False) -> bool:
    """True when a report ends after its first rows of all profiles together."""
    return check_limit(limit) >= 0 and not per_profile


def owner(per_profile: bool) -> list[str]:
    """The leading columns of a report whose rows belong to a profile each."""
    return [PROFILE] if per_profile else []


def reach_of(limit: int) -> int:
    """How many leading rows to try before joining whole tables."""
    return min(5 * limit + 1000, 2**31 - 1)


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has at most ``rows`` rows, marked for broadcasting if that bound is small."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def leading(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each profile, in no order; Spark cuts every task's rows before it shuffles them,
    so a profile with very many is no hot spot."""
    if check_limit(limit) < 0:
        return df
    rank = F.row_number().over(Window.partitionBy(PROFILE).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def leading_matched(rows: DataFrame, ids: DataFrame, key: str, order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` of each profile's rows that have a match in ``ids``."""
    return leading(rows.join(ids, [key, PROFILE], "left_semi"), order, limit)


def first_rows(df: DataFrame, order: Sequence[Column], limit: int, per_profile: bool = False) -> DataFrame:
    """Sort and cut; 0 keeps nothing, a negative limit keeps everything. With ``per_profile`` each profile's rows are
    cut and come together."""
    if per_profile:
        return leading(df, order, limit).orderBy(PROFILE, *order)
    ordered = df.orderBy(*order)
    return ordered if check_limit(limit) < 0 else ordered.limit(limit)


def merged_first_rows(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """``first_rows`` of rows that no time cuts short: the first rows of every task meet in MERGES tasks before those of
    these meet in one."""
    if not 0 < check_limit(limit) <= MAX_CUT_ROWS:
        return first_rows(df, order, limit)
    rank = F.row_number().over(Window.partitionBy("_task").orderBy(*order))
    ranked = df.withColumn("_task", F.pmod(F.spark_partition_id(), F.lit(MERGES))).withColumn("_rank", rank)
    return first_rows(ranked.where(F.col("_rank") <= limit).drop("_task", "_rank"), order, limit)


def keep(df: DataFrame, test: Column | None) -> DataFrame:
    return df if test is None else df.where(test)


def newest(rank: str, *ties: str) -> list[Column]:
    """Descending by ``rank`` (NULLs last), ties broken by profile and unique ids."""
    return [F.desc_nulls_last(rank), F.asc(PROFILE), *(F.asc(t) for t in ties)]


def ids_of(table: DataFrame, key: str, column: str = "id") -> DataFrame:
    return table.select(PROFILE, F.col(column).alias(key))


def _hours(rows: DataFrame, time: Column, encoding: TimeEncoding) -> DataFrame:
    """(hour, n): rows per hour of a raw time; undated rows have a NULL hour."""
    hour = F.call_function("div", time.try_cast("bigint"), F.lit(encoding.raw_hour))
    return rows.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def recent(
    rows: DataFrame, time: str, encoding: TimeEncoding, need: int, slack_hours: int = 0, counted: Column | None = None
) -> DataFrame:
    """``rows`` without the hours that cannot reach the first ``need`` rows by time.

    Undated rows stay. ``counted`` is the time of the rows that count towards ``need``,
    by default all; ``slack_hours`` keeps that much more below the cut.
    """
    if need <= 0:
        return rows
    hours = _hours(rows, F.col(time) if counted is None else counted, encoding)
    # Every hour holds a row, so the last ``need`` hours suffice: one task sums at most that many.
    last = first_rows(hours.where("hour IS NOT NULL"), [F.desc("hour")], need)
    summed = last.select("hour", F.sum("n").over(Window.orderBy(F.desc("hour"))).alias("seen"))
    # One hour more, because div rounds towards zero.
    enough = F.max(F.when(F.col("seen") >= need, F.col("hour"))) - (1 + slack_hours)
    kind = dict(rows.dtypes)[time]
    cut = F.try_multiply(enough, F.lit(encoding.raw_hour)).cast(kind)
    lowest = F.lit(float("-inf") if kind == "double" else LOWEST)
    return rows.where((F.col(time) >= summed.agg(F.coalesce(cut, lowest)).scalar()) | F.col(time).isNull())


def newest_matched(
    rows: DataFrame,
    matches: Sequence[tuple[DataFrame, str]],
    order: Sequence[Column],
    limit: int,
    time: str | None = None,
    encoding: TimeEncoding | None = None,
    repeating: Sequence[str] = (),
) -> DataFrame:
    """The first ``limit`` of ``rows`` that have a match in every table of ``matches``.

    ``rows`` must be narrow, since a few thousand of them are broadcast. Each match is a
    (profile_id, key) frame and the name of its numeric key; those with repeated keys are named
    in ``repeating``. ``time`` names the leading order column if that is a time.
    """
    reach = reach_of(limit) if time else max(limit, min(reach_of(limit), MAX_CUT_ROWS))
    found = first_rows(recent(rows, time, encoding, reach), order, reach) if time else merged_first_rows(rows, order, reach)
    for ids, key in matches:  # streamed past the few rows
        numbered = found.withColumn("_row", F.monotonically_increasing_id()) if key in repeating else found
        found = ids.join(few(numbered, reach), [key, PROFILE])
        if key in repeating:  # a row counts once, however many matches it has
            found = found.dropDuplicates(["_row"]).drop("_row")
    # Counted through the same hours as the cut, so their shuffle is reused.
    counts = _hours(rows, F.col(time), encoding).agg(F.sum("n")) if time else rows.agg(F.count(F.lit(1)))
    total = F.coalesce(counts.scalar(), F.lit(0))
    complete = (F.count(F.lit(1)) >= limit) | (total <= reach)
    # No id is as high as HIGHEST or as low as LOWEST, so one comparison opens or closes a branch.
    gate = found.agg(F.when(complete, F.lit(HIGHEST)).otherwise(F.lit(LOWEST))).scalar()
    first_key = matches[0][1]
    quick = first_rows(found, order, limit).where(F.col(first_key) <= gate)
    rest = rows.where(F.col(first_key) >= gate)
    for ids, key in matches:
        rest = rest.join(ids.where(F.col(key) >= gate), [key, PROFILE], "left_semi")
    return first_rows(quick.unionByName(rest), order, limit)


def attach(rows: DataFrame, parent: DataFrame, key: str, columns: dict[str, str], limit: int) -> DataFrame:
    """Inner N:1 join of at most ``limit`` narrow rows to their parents, renaming parent columns."""
    wide = parent.select(PROFILE, F.col("id").alias(key), *(F.col(c).alias(n) for c, n in columns.items()))
    return wide.join(few(rows, limit), [key, PROFILE])


def fetch(table: DataFrame, rows: DataFrame, key: str, limit: int) -> DataFrame:
    """Rows of ``table`` whose key occurs in at most ``limit`` rows; only the keys are broadcast."""
    return table.join(few(rows.select(PROFILE, key), limit), [key, PROFILE], "left_semi")


def page_names(pages: DataFrame, key: str, *columns: str) -> DataFrame:
    return pages.select(PROFILE, F.col("id").alias(key), *columns)


def referrer_urls(
    rows: DataFrame, visits: DataFrame, pages: DataFrame, link: str, page: str, limit: int
) -> DataFrame:
    """(profile_id, link, _url) for the visits that at most ``limit`` rows point to through ``link``."""
    hops = fetch(visits.select(PROFILE, F.col("id").alias(link), F.col(page).alias("_page")), rows, link, limit)
    return attach(hops, pages, "_page", {"url": "_url"}, limit).select(PROFILE, link, "_url")


def page_of_visit(visits: DataFrame, pages: DataFrame, page: str) -> DataFrame:
    """(profile_id, id, _url) of every visit with a known page: the whole referrer side."""
    urls = pages.select(PROFILE, F.col("id").alias(page), F.col("url").alias("_url"))
    return visits.select(PROFILE, "id", page).join(urls, [page, PROFILE]).select(PROFILE, "id", "_url")


def join_links(rows: DataFrame, targets: DataFrame, link: str, url: str) -> DataFrame:
    """Left join of all rows to their linked visit's URL, safe against the "no link" values 0 and NULL.

    These are sure to be hot. Their rows are spread over salts and a target with id 0, if there
    is one, is copied to each salt; all other ids use salt 0. NULL matches nothing.
    """
    salt = F.when(F.col(link).isNull() | (F.col(link) == 0), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    copies = F.when(F.col("id") == 0, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = targets.select(PROFILE, F.col("id").alias(link), F.col("_url").alias(url), F.explode(copies).alias("_salt"))
    return rows.withColumn("_salt", salt).join(right, [link, PROFILE, "_salt"], "left").drop("_salt")
