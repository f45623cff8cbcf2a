"""Reading browser history databases (SQLite files) into typed rows.

Each file is read once: binary rows go to Python workers, which open the bytes in
memory and stream every needed table back as Arrow batches. One output frame carries
all tables, one struct column per table, so landing needs one pass over the files.

Files must be checkpointed copies: changes still in a ``-wal`` file are not seen.
"""

from __future__ import annotations

import re
import sqlite3
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagetrail.functions.timecodec import CHROMIUM_TIME, FIREFOX_TIME, SAFARI_TIME, local_time
from pagetrail.schemas import CHROMIUM, FAMILIES, PROFILE, TIME_COLUMNS, table_schema
from pagetrail.sources.profiles import DATABASE_FILES

# Worker code travels with the job; executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REJECTED, READ = "rejected", "read"
ROWS_PER_BATCH, CHARS_PER_BATCH = 10_000, 1 << 24
#: A file is loaded whole by one task.
MAX_FILE_BYTES = 1 << 30
TIME_ENCODINGS = {"chromium": CHROMIUM_TIME, "firefox": FIREFOX_TIME, "safari": SAFARI_TIME}
#: Years whose rows are landed by month; all other rows are landed together.
LANDED_YEARS = (1990, 2100)
UNDATED = "undated"
ARROW_TYPES = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}


def history_files(spark: SparkSession, path: str | Sequence[str], browser: str, recursive: bool = False) -> DataFrame:
    """(profile_id, content) of database files; the profile is the file's directory.

    ``path`` names database files; with ``recursive`` it names directories to search
    for files of the browser's usual name. A missing path is an error. A file of more than
    MAX_FILE_BYTES is not loaded: its content is NULL, and reading it rejects it.
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", DATABASE_FILES[browser])
    files = reader.load(path if isinstance(path, str) else list(path))
    profile, size = F.regexp_replace("path", "/[^/]*$", "").alias(PROFILE), F.col("length")
    too_large = files.where(size > MAX_FILE_BYTES).select(profile, F.lit(None).cast("binary").alias("content"))
    return files.where(size <= MAX_FILE_BYTES).select(profile, "content").unionByName(too_large)


def _as_long(value):
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    elif isinstance(value, str) and (number := re.fullmatch(r"\s*([+-]?)0*([0-9]{1,19})\s*", value)):
        value = int(number[1] + number[2])
    return value if isinstance(value, int) and -(2**63) <= value < 2**63 else None


def _as_double(value):
    try:
        return None if isinstance(value, bytes) else float(value)
    except (TypeError, ValueError):
        return None


def _as_text(value):
    if isinstance(value, bytes):
        return value.decode("utf-8", "replace")
    return value if value is None or isinstance(value, str) else str(value)


CASTS = {"bigint": _as_long, "double": _as_double, "string": _as_text}


def _open(content: bytes) -> sqlite3.Connection:
    image = bytearray(content)
    if image[18:20] == b"\x02\x02":  # write-ahead-log mode; an in-memory copy has no log
        image[18:20] = b"\x01\x01"
    db = sqlite3.connect(":memory:")
    db.text_factory = lambda raw: raw.decode("utf-8", "replace")
    db.deserialize(image)
    return db


def _queries(db: sqlite3.Connection, family: dict[str, list[tuple[str, str]]]) -> dict[str, tuple[str, str]]:
    """Per existing table: the select list with NULL for absent columns, and a check that reads every value."""
    queries = {}
    for table, columns in family.items():
        present = {row[1] for row in db.execute(f'PRAGMA table_info("{table}")')}
        wanted = [f'"{name}"' if name in present else "NULL" for name, _ in columns]
        if present:
            read = f'SELECT {", ".join(wanted)} FROM "{table}"'
            check = f'SELECT count(*), {", ".join(f"max({w})" for w in wanted)} FROM "{table}"'
            queries[table] = (read, check)
    return queries


def _chunks(cursor: sqlite3.Cursor) -> Iterator[list[tuple]]:
    """Rows by the batch, bounded in number and in characters."""
    rows, size = [], 0
    for row in cursor:
        rows.append(row)
        size += sum(len(v) for v in row if isinstance(v, str | bytes))
        if len(rows) >= ROWS_PER_BATCH or size >= CHARS_PER_BATCH:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _row_reader(family: dict[str, list[tuple[str, str]]]):
    """mapInArrow function over (profile_id, content) batches."""
    structs = {t: pa.struct([(n, ARROW_TYPES[k]) for n, k in cols]) for t, cols in family.items()}

    def batch(profile: str, table: str, count: int, values=None, error: str | None = None) -> pa.RecordBatch:
        columns = {
            PROFILE: pa.array([profile] * count, pa.string()),
            "table_name": pa.array([table] * count, pa.string()),
            "error": pa.array([error] * count, pa.string()),
        }
        for name, struct in structs.items():
            columns[name] = values if name == table else pa.nulls(count, struct)
        return pa.RecordBatch.from_pydict(columns)

    def tables_of(profile: str, content: bytes) -> Iterator[pa.RecordBatch]:
        db = None
        try:
            if content is None:
                raise ValueError(f"the file has more than {MAX_FILE_BYTES} bytes")
            db = _open(content)
            queries = _queries(db, family)
            if not queries:
                raise sqlite3.DatabaseError("no history tables")
            for _, check in queries.values():
                db.execute(check).fetchall()
        except Exception as problem:  # whatever one file holds, it must not end the job
            yield batch(profile, REJECTED, 1, error=str(problem))
            return
        yield batch(profile, READ, 1)
        for table, (read, _) in queries.items():
            for rows in _chunks(db.execute(read)):
                arrays = [
                    pa.array([CASTS[kind](v) for v in column], ARROW_TYPES[kind])
                    for (_, kind), column in zip(family[table], zip(*rows))
                ]
                values = pa.StructArray.from_arrays(arrays, fields=list(structs[table]))
                yield batch(profile, table, len(rows), values)
        db.close()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for profile, content in zip(files.column(0), files.column(1)):
                yield from tables_of(profile.as_py(), content.as_py())

    return read


def history_rows(files: DataFrame, browser: str) -> DataFrame:
    """All rows of all files: ``profile_id, table_name, error`` and one struct column per table.

    A file that cannot be read completely yields one row with table_name ``rejected`` and
    nothing else; any other yields one row ``read`` beside its tables. Text in a number column
    becomes NULL unless it spells a number.
    """
    columns = {
        table: [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl)]
        for table, ddl in FAMILIES[browser].items()
    }
    return files.select(PROFILE, "content").mapInArrow(_row_reader(columns), _row_schema(browser))


def _row_schema(browser: str) -> str:
    tables = FAMILIES[browser].items()
    structs = ", ".join(f"{table} struct<{ddl.replace(' ', ':').replace(',:', ', ')}>" for table, ddl in tables)
    return f"{PROFILE} string, table_name string, error string, {structs}"


def land(files: DataFrame, browser: str, path: str, snapshot: str) -> None:
    """Write all tables of all files in one pass, by browser, snapshot, table and month, sorted by time.

    ``snapshot`` names this state of the files; names must sort by age, as dates do. All files of a
    snapshot are landed together: landing it again replaces it, so a repeated job adds no row. Months
    with much data are split over several files and small ones put together by size.
    """
    if not re.fullmatch(r"[0-9A-Za-z][0-9A-Za-z_.-]*", snapshot):
        raise ValueError(f"invalid snapshot name {snapshot!r}")
    family = FAMILIES[browser]
    # A row fills the struct of its own table only, so the first time that is there is its time.
    time = F.coalesce(*(F.col(f"{table}.{TIME_COLUMNS[table]}") for table in family if table in TIME_COLUMNS))
    when = local_time(TIME_ENCODINGS[_family_of(browser)].unix_seconds(time), "UTC")
    month = F.when(F.year(when).between(*LANDED_YEARS), F.substring(when.cast("string"), 1, 7)).otherwise(UNDATED)
    rows = history_rows(files, browser).withColumn("month", month)
    laid = rows.hint("rebalance", F.col("table_name"), F.col("month")).sortWithinPartitions("table_name", "month", time)
    target = f"{path}/{_family_of(browser)}/browser={browser}/snapshot={snapshot}"
    writer = laid.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("table_name", "month").parquet(target)


def _family_of(browser: str) -> str:
    """Directory of a schema family: browsers of one family share a landing area."""
    return "chromium" if FAMILIES[browser] is CHROMIUM else browser


def tables_from(rows: DataFrame, browser: str) -> dict[str, DataFrame]:
    """Split ``history_rows`` output into typed tables."""
    return {table: typed_rows(rows, browser, table) for table in FAMILIES[browser]}


def typed_rows(rows: DataFrame, browser: str, table: str, *more: str) -> DataFrame:
    """One typed table of ``history_rows`` output, with more of its columns behind the profile."""
    names = table_schema(FAMILIES[browser], table).names[1:]
    return rows.where(F.col("table_name") == table).select(PROFILE, *more, *(F.col(f"{table}.{n}").alias(n) for n in names))


def rejected(rows: DataFrame) -> DataFrame:
    """(profile_id, error) of the files that were skipped."""
    return rows.where(F.col("table_name") == REJECTED).select(PROFILE, "error")


def landed_rows(spark: SparkSession, path: str, browser: str) -> DataFrame:
    """The rows of all landed snapshots of one browser."""
    schema = f"{_row_schema(browser)}, browser string, snapshot string, month string"
    return spark.read.schema(schema).parquet(f"{path}/{_family_of(browser)}").where(F.col("browser") == browser)


def _newest(rows: DataFrame) -> DataFrame:
    """(profile_id, snapshot): the newest that could be read, else the newest; there is one mark a landed file."""
    marks = rows.where(F.col("table_name").isin(READ, REJECTED)).groupBy(PROFILE)
    readable = F.max(F.when(F.col("table_name") == READ, F.col("snapshot")))
    return marks.agg(F.coalesce(readable, F.max("snapshot")).alias("snapshot"))


def landed(spark: SparkSession, path: str, browser: str, snapshot: str | None = None) -> DataFrame:
    """Landed rows of one browser, in the layout of ``history_rows``.

    Without ``snapshot`` each profile is shown as its newest readable file had it, or as rejected if
    none could be read; with it, as that snapshot has it, which costs no join.
    """
    rows = landed_rows(spark, path, browser)
    if snapshot is not None:
        return rows.where(F.col("snapshot") == snapshot)
    return rows.join(_newest(rows), [PROFILE, "snapshot"], "left_semi")


def landed_tables(spark: SparkSession, path: str, browser: str, snapshot: str | None = None) -> dict[str, DataFrame]:
    """Typed tables of ``landed``. Their columns are taken out below the join with the newest snapshots, so that
    nested column pruning and date filters reach the scan."""
    rows = landed_rows(spark, path, browser)
    if snapshot is not None:
        return tables_from(rows.where(F.col("snapshot") == snapshot), browser)
    newest = _newest(rows)
    return {
        table: typed_rows(rows, browser, table, "snapshot").join(newest, [PROFILE, "snapshot"], "left_semi").drop("snapshot")
        for table in FAMILIES[browser]
    }


def of_profiles(tables: dict[str, DataFrame], chosen: DataFrame) -> dict[str, DataFrame]:
    """Tables restricted to the databases picked by ``select_profiles``."""
    path = F.concat_ws("/", "root", "db_path")
    ids = chosen.where("found").select(F.regexp_replace(path, "/[^/]*$", "").alias(PROFILE))
    return {name: table.join(ids, PROFILE, "left_semi") for name, table in tables.items()}
