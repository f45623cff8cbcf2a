"""Tabs saved by a tab-manager extension, recovered from its raw storage files.

Input rows are whole files, ``schemas.SAVED_TAB_FILES``. The files are not parsed as a
key-value store; JSON fragments are matched in the decoded bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.plans.newest import SALTS, check_limit, first_rows
from pagetrail.schemas import PROFILE

# ---- fixed values: patterns and limits -----------------------------------
GROUP_PATTERN = r'\[\{[^\]]*\}[,\s]*\],?"createDate":\d+'
PAIR_PATTERN = r'"url":"(https?://[^"]+)","title":"([^"]*)"'
TAB_SCHEMA = "array<struct<url:string,title:string>>"
#: characters an unreadable title is reduced to; the rest is removed
NOT_PRINTABLE = r"[^\x20-\x7E\u0080-\uFFFF]"
CONTROL = r"[\x00-\x1F]"
CONTROL_BUT_BLANK = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
MAX_TITLE_CHARS = 500
REPLACEMENT = "\ufffd"
#: last millisecond of the year 9999; groups dated later are unreadable
LAST_MILLISECOND = 253_402_300_799_999
# --------------------------------------------------------------------------

#: the JSON dialect of the stored groups: strictly standard
STRICT_JSON = {"allowSingleQuotes": "false"}

GROUPED, LOOSE = 0, 1
POSITION = ("file_name", "kind", "part", "tab")


def _text(content: Column) -> Column:
    """Bytes as UTF-8, invalid sequences replaced by U+FFFD, ``\\"`` unescaped."""
    decoded = F.make_valid_utf8(content.cast("string"))
    return F.replace(decoded, F.lit('\\"'), F.lit('"'))


def _tabs(files: DataFrame) -> DataFrame:
    """All tabs of all files with their places: those in dated groups, and URL/title pairs found anywhere.

    Both patterns are searched for in the same pass over a file's text, which goes no further than this. A group whose
    JSON or date is unreadable yields nothing; pairs have no date.
    """
    text = _text(F.col("content"))

    def found(pattern: str, kind: int) -> Column:
        every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.transform(every, lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("part"), m.alias("match")))

    both = F.concat(found(GROUP_PATTERN, GROUPED), found(PAIR_PATTERN, LOOSE))
    rows = files.select(PROFILE, "file_name", F.explode(both).alias("m")).select(PROFILE, "file_name", "m.*")
    grouped = F.col("kind") == GROUPED
    millis = F.when(grouped, F.substring_index("match", ":", -1).try_cast("bigint"))
    # The match holds no "]" before the one that closes the array.
    array = F.when(grouped, F.concat(F.substring_index("match", "]", 1), F.lit("]")))
    title = F.regexp_extract("match", PAIR_PATTERN, 2)
    cleaned = F.when(title.rlike(CONTROL_BUT_BLANK), F.regexp_replace(title, NOT_PRINTABLE, "")).otherwise(title)
    pair = F.array(F.struct(F.regexp_extract("match", PAIR_PATTERN, 1).alias("url"), cleaned.alias("title")))
    tabs = F.when(grouped, F.from_json(array, TAB_SCHEMA, STRICT_JSON)).otherwise(pair)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    date = F.timestamp_add("SECOND", F.call_function("div", F.col("ms"), F.lit(1000)), epoch).cast("string")
    dated = rows.withColumn("ms", millis).where(~grouped | (F.col("ms") <= LAST_MILLISECOND))
    dated = dated.select(PROFILE, "file_name", "kind", "part", "ms", F.posexplode(tabs).alias("tab", "t"))
    return dated.select(
        PROFILE,
        *POSITION,
        F.col("t.url").alias("url"),
        F.coalesce("t.title", F.lit("")).alias("title"),
        F.coalesce(date, F.lit("")).alias("group_date"),
    ).where(F.col("url") != "")


def grouped_tabs(files: DataFrame) -> DataFrame:
    """Tabs inside dated groups. A group whose JSON or date is unreadable yields nothing."""
    return _tabs(files).where(F.col("kind") == GROUPED)


def loose_tabs(files: DataFrame) -> DataFrame:
    """URL/title pairs found anywhere in the file, without a date."""
    return _tabs(files).where(F.col("kind") == LOOSE)


def _readable() -> Column:
    title = F.col("title")
    return ~(
        title.rlike(CONTROL_BUT_BLANK)
        | F.col("odd")
        | title.contains(REPLACEMENT)
        | (F.length(title) > MAX_TITLE_CHARS)
    )


def saved_tabs(files: DataFrame, limit: int = 100) -> DataFrame:
    """Saved tabs in file order; each URL once, by its first occurrence, unreadable ones dropped.

    ``limit`` <= 0 keeps every row. The first occurrence is chosen before the readability
    test, so an unreadable first copy hides a good later one.
    """
    # Tests of the URL are made here: later ones would be pushed below one of the two uses of the first copies only.
    copy = F.struct(F.struct(*POSITION).alias("position"), "title", "group_date", F.col("url").rlike(CONTROL).alias("odd"))
    firsts = _tabs(files).groupBy(PROFILE, "url").agg(
        F.min(F.when(F.col("kind") == GROUPED, copy)).alias("grouped"), F.min(F.when(F.col("kind") == LOOSE, copy)).alias("loose")
    )
    # Loose pairs count only in files before a profile's first file with a grouped tab. One profile may own most
    # URLs, so its single "first file" row is copied to every salt. Both sides share the shuffle of the first copies.
    # The test is always true; it makes this side need the same columns, or the files would be searched for it again.
    either = F.col("grouped").isNotNull() | F.col("loose").isNotNull()
    first = firsts.groupBy(F.col(PROFILE).alias("_profile")).agg(F.min(F.when(either, F.col("grouped.position.file_name"))).alias("first_file"))
    first = first.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int")
    # eqNullSafe and the outer join for the same reason: others would add a test for NULL to one side.
    gated = firsts.join(first, F.col(PROFILE).eqNullSafe(F.col("_profile")) & (salt == F.col("_copy")), "left")
    early = F.col("first_file").isNull() | (F.col("loose.position.file_name") < F.col("first_file"))
    chosen = F.when(F.col("loose").isNotNull() & early, F.col("loose")).otherwise(F.col("grouped"))
    rows = gated.select(PROFILE, "url", chosen.alias("first")).where("first IS NOT NULL")
    rows = rows.select(PROFILE, "url", "first.*").where(_readable())
    order = [F.asc(PROFILE), F.asc("position")]
    return first_rows(rows, order, limit if check_limit(limit) > 0 else -1).select("url", "title", "group_date")
