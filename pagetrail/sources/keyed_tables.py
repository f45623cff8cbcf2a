"""Landed tables kept as buckets of their page keys, so that unlimited reports shuffle no table.

Rows are dealt to buckets by (page, profile, salt). The salt spreads the rows of a page with very many visits, and such
a page is kept once per salt, so no bucket gathers a hot page. What a visit is linked to is looked up once, when the
tables are kept: visits carry the URLs of the visits they came from or went to, annotations the page and time of their
visit. Rows and pages of a bucket then join where they lie. Within a bucket rows are sorted by time.

``keyed_tables`` holds every table under its own name, each page once, for the short reports, and the rows joined to
their pages under ``named_<table>``, which the unlimited reports take where it is present.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.plans.newest import join_links, page_of_visit
from pagetrail.schemas import CHROMIUM_BROWSERS, FAMILIES, PROFILE, TIME_COLUMNS

Tables = Mapping[str, DataFrame]

BUCKETS = 1024
#: Visits of one page that share a salt.
ROWS_PER_SALT = 250_000
SALT = "salt"
#: Salts of the rows without a page, which join none.
LOOSE_SALTS = 64
#: Where the names of the kept tables are.
KEPT = "_kept"


@dataclass(frozen=True)
class Layout:
    """Which tables of a family hang on pages, and through which columns."""

    pages: str
    visits: str
    page: str
    time: str
    links: tuple[str, ...]
    #: table -> its column with the visit's id
    notes: dict[str, str] = field(default_factory=dict)
    #: table -> its column with the page's id
    by_page: dict[str, str] = field(default_factory=dict)

    def key_of(self, table: str) -> str:
        """The column of a kept table that holds the page."""
        return {self.pages: "id", self.visits: self.page, **self.by_page}.get(table, "page")

    @property
    def tables(self) -> tuple[str, ...]:
        return (self.pages, self.visits, *self.notes, *self.by_page)


_CHROMIUM = Layout(
    "urls",
    "visits",
    "url",
    "visit_time",
    ("from_visit",),
    {"content_annotations": "visit_id", "context_annotations": "visit_id"},
    {"keyword_search_terms": "url_id"},
)
LAYOUTS = {
    **dict.fromkeys(CHROMIUM_BROWSERS, _CHROMIUM),
    "firefox": Layout(
        "moz_places", "moz_historyvisits", "place_id", "visit_date", ("from_visit",), by_page={"moz_inputhistory": "place_id"}
    ),
    "safari": Layout(
        "history_items", "history_visits", "history_item", "visit_time", ("redirect_source", "redirect_destination")
    ),
}


def _salted(rows: DataFrame, key: str, salts: DataFrame, spread: Column) -> DataFrame:
    """``rows`` with the salt that ``spread`` chooses among those of their page, or of rows without one."""
    found = rows.join(salts.withColumnRenamed("page", key), [key, PROFILE], "left")
    every = F.when(F.col(key).isNull(), F.lit(LOOSE_SALTS)).otherwise(F.coalesce(F.col("salts"), F.lit(1)))
    salt = F.pmod(F.xxhash64(spread), every).cast("int")
    return found.withColumn(SALT, salt).drop("salts")


def _laid(tables: Tables, layout: Layout, rows_per_salt: int) -> dict[str, DataFrame]:
    visits, pages = tables[layout.visits], tables[layout.pages]
    per_page = visits.groupBy(PROFILE, F.col(layout.page).alias("page")).agg(F.count(F.lit(1)).alias("n"))
    hot = per_page.where(F.col("n") > rows_per_salt)
    salts = hot.select(PROFILE, "page", F.ceil(F.col("n") / rows_per_salt).cast("int").alias("salts"))
    copies = pages.join(salts.withColumnRenamed("page", "id"), ["id", PROFILE], "left")
    every = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
    laid = {layout.pages: copies.withColumn(SALT, F.explode(every)).drop("salts")}
    targets = page_of_visit(visits.withColumnRenamed(layout.page, "_page"), pages, "_page")
    linked = visits
    for link in layout.links:
        linked = join_links(linked, targets, link, f"{link}_url")
    laid[layout.visits] = _salted(linked, layout.page, salts, F.col("id"))
    for table, column in layout.notes.items():
        timed = visits.select(PROFILE, F.col("id").alias(column), F.col(layout.page).alias("page"), layout.time)
        laid[table] = _salted(tables[table].join(timed, [column, PROFILE], "left"), "page", salts, F.col(column))
    for table, column in layout.by_page.items():
        laid[table] = _salted(tables[table], column, salts, F.struct(*tables[table].columns))
    return laid


def keep_keyed(
    tables: Tables, browser: str, path: str, buckets: int = BUCKETS, rows_per_salt: int = ROWS_PER_SALT
) -> None:
    """Keep the tables of one browser under ``path``, in place of what was kept there.

    Tables without a page (downloads, bookmarks) are kept as they are. The list of the tables is written last: without
    it nothing can be read.
    """
    layout = _layout(browser)
    spark = tables[layout.pages].sparkSession
    laid = _laid(tables, layout, rows_per_salt)
    for name in FAMILIES[browser]:
        target, at = f"{path}/{browser}/{name}", _name(path, browser, name)
        spark.sql(f"DROP TABLE IF EXISTS {at}")
        rows = laid.get(name, tables[name])
        time = TIME_COLUMNS.get(name, layout.time if name in layout.notes else None)
        if name not in laid:
            rows.write.mode("overwrite").parquet(target)
            continue
        keys = [layout.key_of(name), PROFILE, SALT]
        # Partitions are the buckets, so each bucket is one file.
        writer = rows.repartition(buckets, *keys).write.mode("overwrite").option("path", target)
        writer = writer.bucketBy(buckets, *keys).sortBy(time or layout.key_of(name))
        writer.format("parquet").saveAsTable(at)
    kept = spark.createDataFrame([(name, buckets) for name in laid], "table string, buckets int")
    kept.coalesce(1).write.mode("overwrite").parquet(f"{path}/{browser}/{KEPT}")


def _layout(browser: str) -> Layout:
    if browser not in LAYOUTS:
        raise ValueError(f"browser must be one of {sorted(LAYOUTS)}, got {browser!r}")
    return LAYOUTS[browser]


def _name(path: str, browser: str, table: str) -> str:
    """The catalog's name of a kept table; it is only needed for the bucket layout, the data are under the path."""
    return f"keyed_{sha256(path.encode()).hexdigest()[:16]}_{browser}_{table}"


def _kept(spark: SparkSession, path: str, browser: str, table: str, keys: list[str], buckets: int) -> DataFrame:
    """The table with its buckets, which Parquet files alone do not tell; another session kept it, perhaps."""
    name, target = _name(path, browser, table), f"{path}/{browser}/{table}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(target).schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{target}'"
        )
    return spark.table(name)


def keyed_tables(spark: SparkSession, path: str, browser: str) -> dict[str, DataFrame]:
    """The kept tables of one browser, and ``named_<table>``: rows joined to their pages without a shuffle.

    A named row has the columns of its table, the page's, and ``<link>_url`` for each link of a visit (NULL if it leads
    nowhere); annotations have ``page`` and the time of their visit. Rows without a page are in no named table.
    """
    layout = _layout(browser)
    buckets = dict(map(tuple, spark.read.parquet(f"{path}/{browser}/{KEPT}").collect()))  # one row a table
    kept = {
        name: _kept(spark, path, browser, name, [layout.key_of(name), PROFILE, SALT], buckets[name]) for name in layout.tables
    }
    found: dict[str, DataFrame] = {
        name: spark.read.parquet(f"{path}/{browser}/{name}") for name in FAMILIES[browser] if name not in kept
    }
    pages = kept[layout.pages]
    found[layout.pages] = pages.where(F.col(SALT) == 0).drop(SALT)
    for name in layout.tables[1:]:
        key = layout.key_of(name)
        added = [SALT, *(f"{link}_url" for link in layout.links if name == layout.visits)]
        added += ["page", layout.time] if name in layout.notes else []
        found[name] = kept[name].drop(*added)
        rows = kept[name].withColumnRenamed(key, "page")
        clash = set(rows.columns) - {"page", PROFILE, SALT}
        named = pages.select(F.col("id").alias("page"), *(c for c in pages.columns if c != "id" and c not in clash))
        found[f"named_{name}"] = rows.join(named, ["page", PROFILE, SALT]).drop(SALT)
    return found
