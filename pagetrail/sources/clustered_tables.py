"""Landed tables clustered by profile and time together, with a manifest that names the files of a profile's days.

Rows are sorted along a space-filling (Z-order) curve over the hash of the profile and the time of the row: two rows that
are near in both lie near on the curve, so a file holds some profiles for some time. The manifest has one row for
each file and profile slot with the times that the file holds of it; it is written by slot, so a reader that looks for
a few profiles opens few of its row groups, and then only the files that it names.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.functions.timecodec import CHROMIUM_TIME, FIREFOX_TIME, SAFARI_TIME, date_bounds, in_dates
from pagetrail.plans.newest import keep
from pagetrail.schemas import CHROMIUM_BROWSERS, FAMILIES, PROFILE, TIME_COLUMNS, table_schema

Tables = Mapping[str, DataFrame]

#: Bits of the profile's hash and of the time that the curve goes through, and how much of the rows' times is spread over
#: them: a few odd times must not squeeze all others into one.
BITS, MIDDLE = 16, (0.005, 0.995)
#: Rows of a file, and of a task that writes files smaller than that: each task sends its bounds and results to the driver.
FILE_ROWS, TASK_ROWS = 2_000_000, 200_000
#: Files beyond which a reader that names profiles is better served by reading the folder.
MOST_FILES = 10_000
MANIFEST = "_files"
ENCODINGS = {**dict.fromkeys(CHROMIUM_BROWSERS, CHROMIUM_TIME), "firefox": FIREFOX_TIME, "safari": SAFARI_TIME}


def slot_of(profile: Column) -> Column:
    return F.pmod(F.xxhash64(profile), F.lit(1 << BITS)).cast("bigint")


def _stretch(rows: DataFrame, time: str | None) -> Column:
    """The time of a row as a number of BITS bits, 0 where there is none."""
    if time is None:
        return F.lit(0).cast("bigint")
    seconds = F.col(time).try_cast("double")
    low, high = rows.agg(F.percentile_approx(seconds, list(MIDDLE))).first()[0] or (0.0, 0.0)
    most = (1 << BITS) - 1
    place = (seconds - low) / max(high - low, 1.0) * most
    return F.coalesce(F.greatest(F.lit(0.0), F.least(place, F.lit(float(most)))), F.lit(0.0)).cast("bigint")


def _spread(number: Column) -> Column:
    """The bits of a number at every second place."""
    one = F.lit(1).cast("bigint")
    return reduce(Column.bitwiseOR, (F.shiftleft(F.shiftright(number, i).bitwiseAND(one), 2 * i) for i in range(BITS)))


def curve(profile_slot: Column, stretch: Column) -> Column:
    """The place on the curve: bits of both, taken in turn from the highest on."""
    return F.shiftleft(_spread(profile_slot), 1).bitwiseOR(_spread(stretch))


def keep_clustered(tables: Tables, browser: str, path: str, file_rows: int = FILE_ROWS) -> None:
    """Write the tables of one browser under ``path``, each with its manifest, in place of what was there.

    A task writes a stretch of the curve, as one file after the other where ``file_rows`` is below TASK_ROWS.
    """
    files_each = max(1, TASK_ROWS // file_rows)
    for name in FAMILIES[browser]:
        rows, time = tables[name], TIME_COLUMNS.get(name)
        target = f"{path}/{browser}/{name}"
        slot = slot_of(F.col(PROFILE))
        order = [F.col("_curve"), *([F.col(time)] if time else []), F.xxhash64(*rows.columns)]
        placed = rows.withColumn("_curve", curve(slot, _stretch(rows, time)))
        tasks = max(1, -(-rows.count() // (file_rows * files_each)))
        # The hash splits rows that share profile and time.
        placed = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("_curve")
        most = file_rows if files_each > 1 else 0
        placed.write.mode("overwrite").option("maxRecordsPerFile", most).parquet(target)
        kept = rows.sparkSession.read.schema(rows.schema).parquet(target)
        times = F.col(time).cast("double") if time else F.lit(None).cast("double")
        per_file = kept.groupBy(F.col("_metadata.file_path").alias("file"), slot.alias("slot")).agg(
            F.min(times).alias("first"), F.max(times).alias("last"), F.count_if(times.isNull()).alias("undated")
        )
        per_file.repartitionByRange("slot").sortWithinPartitions("slot", "first").write.mode("overwrite").parquet(
            f"{path}/{browser}/{MANIFEST}/{name}"
        )


def files_of(manifest: DataFrame, slots: Sequence[int] | None, low: float | None, high: float | None) -> DataFrame:
    """(file) of a manifest's files that can hold rows of these slots and times; rows without a time are in no range."""
    rows = manifest if slots is None else manifest.where(F.col("slot").isin(list(slots)))
    if low is not None:
        rows = rows.where(F.col("last") >= low)
    if high is not None:
        rows = rows.where(F.col("first") < high)
    return rows.select("file").distinct()


def clustered_rows(
    spark: SparkSession,
    path: str,
    browser: str,
    table: str,
    profiles: Sequence[str] | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """The rows of one kept table of some profiles and days, all by default, from the files that can hold them.

    The names of these files reach the driver; where there are more than MOST_FILES the whole folder is read, and the
    filters skip its row groups.
    """
    schema = table_schema(FAMILIES[browser], table)
    time, encoding = TIME_COLUMNS.get(table), ENCODINGS[browser]
    low, high = date_bounds(encoding, date_from, date_to, tz)
    if time is None and (date_from or date_to):
        raise ValueError(f"{table} has no time")
    slots = None
    if profiles is not None:
        named = spark.createDataFrame([(p,) for p in profiles], f"{PROFILE} string")
        slots = [r.slot for r in named.select(slot_of(F.col(PROFILE)).alias("slot")).distinct().collect()]
    files = None
    if slots is not None or low is not None or high is not None:
        manifest = spark.read.parquet(f"{path}/{browser}/{MANIFEST}/{table}")
        files = [r.file for r in files_of(manifest, slots, low, high).limit(MOST_FILES + 1).collect()]
    if files == []:
        rows = spark.createDataFrame([], schema)
    elif files is None or len(files) > MOST_FILES:
        rows = spark.read.schema(schema).parquet(f"{path}/{browser}/{table}")
    else:
        rows = spark.read.schema(schema).parquet(*files)
    if profiles is not None:
        rows = rows.where(F.col(PROFILE).isin(list(profiles)))
    return keep(rows, in_dates(F.col(time), encoding, date_from, date_to, tz)) if time else rows


class ClusteredTables(Mapping):
    """The kept tables of one browser, cut to some profiles; each is opened when it is asked for.

    Their visits are cut to days by ``within``, which reads fewer files than the reports' own filters; a report of the
    same days is then the same, but for links to visits before them.
    """

    def __init__(self, spark: SparkSession, path: str, browser: str, profiles: Sequence[str] | None = None) -> None:
        self._spark, self._path, self._browser, self._profiles = spark, path, browser, profiles

    def __getitem__(self, name: str) -> DataFrame:
        if name not in FAMILIES[self._browser]:
            raise KeyError(name)
        return self.within(name)

    def within(self, name: str, date_from: str | None = None, date_to: str | None = None, tz: str = "UTC") -> DataFrame:
        return clustered_rows(self._spark, self._path, self._browser, name, self._profiles, date_from, date_to, tz)

    def __iter__(self) -> Iterator[str]:
        return iter(FAMILIES[self._browser])

    def __len__(self) -> int:
        return len(FAMILIES[self._browser])
