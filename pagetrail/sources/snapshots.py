"""One history out of all landed snapshots of a profile.

Browsers drop visits after some months, so the newest file holds only a part of what was seen. Landing writes, beside
the rows, a digest of each profile's rows in each table and month. From these it follows at which snapshots a month
changed; only those are read, and a month that never changed is taken as it is.

Within one snapshot an id names one row; over time it can name several. A row is told by its id and what cannot change:
the time of a visit, the URL of a page. The newest row of an id keeps it, each older one gets a negative id of its own,
and links follow to the row that had the id when the linking row was first seen. Of the versions of a row, the newest
stays.

A visit that is gone from a file which still holds older ones was not dropped for its age: somebody deleted it. Such
tombstones can be listed, and their visits left out.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagetrail.plans.kept import kept
from pagetrail.schemas import CHROMIUM_BROWSERS, FAMILIES, PROFILE
from pagetrail.sources import history_files

Tables = Mapping[str, DataFrame]

#: Where in a profile's sequence of snapshots a row was first and last seen.
FIRST, LAST = "first_seen", "last_seen"
#: Parts that the rows of a profile with reused ids are numbered in.
PARTS = 64


@dataclass(frozen=True)
class Told:
    """What tells the rows of a table apart, beside their ``id`` if they have one, and the tables its columns link to."""

    by: tuple[str, ...]
    links: dict[str, str] = field(default_factory=dict)
    #: such a row stays in one month, as its time is part of what tells it apart
    settles: bool = False
    numbered: bool = True


_CHROMIUM = {
    "urls": Told(("url",)),
    "visits": Told(("visit_time",), {"url": "urls", "from_visit": "visits"}, settles=True),
    "downloads": Told(("start_time",), settles=True),
    "keyword_search_terms": Told(("term", "url_id"), {"url_id": "urls"}, numbered=False),
    "content_annotations": Told(("visit_id",), {"visit_id": "visits"}, numbered=False),
    "context_annotations": Told(("visit_id",), {"visit_id": "visits"}, numbered=False),
}
TOLD = {
    **dict.fromkeys(CHROMIUM_BROWSERS, _CHROMIUM),
    "firefox": {
        "moz_places": Told(("url",)),
        "moz_historyvisits": Told(("visit_date",), {"place_id": "moz_places", "from_visit": "moz_historyvisits"}, settles=True),
        "moz_inputhistory": Told(("place_id", "input"), {"place_id": "moz_places"}, numbered=False),
        "moz_bookmarks": Told(("dateAdded",), {"fk": "moz_places", "parent": "moz_bookmarks"}, settles=True),
    },
    "safari": {
        "history_items": Told(("url",)),
        "history_visits": Told(
            ("visit_time",),
            {"history_item": "history_items", "redirect_source": "history_visits", "redirect_destination": "history_visits"},
            settles=True,
        ),
    },
}
#: family's table of visits -> its time
VISITS = {**dict.fromkeys(CHROMIUM_BROWSERS, ("visits", "visit_time")), "firefox": ("moz_historyvisits", "visit_date")}
VISITS["safari"] = ("history_visits", "visit_time")


# ---- which snapshots hold something new --------------------------------------


def spans(digests: DataFrame) -> DataFrame:
    """(profile_id, table_name, month, snapshot, first_seen, last_seen, alone) of each state of a profile's month.

    ``digests`` has a row for every profile, snapshot, table and month, and one of the table ``read`` for every file
    that was read. A state lasts from its snapshot, number first_seen of the profile's, to number last_seen; ``alone``
    marks a month that was never seen otherwise.
    """
    read = digests.where(F.col("table_name") == history_files.READ).select(PROFILE, "snapshot").distinct()
    place = F.row_number().over(Window.partitionBy(PROFILE).orderBy("snapshot")).cast("bigint")
    placed = read.withColumn("place", place)
    states = digests.where(F.col("table_name") != history_files.READ).join(placed, [PROFILE, "snapshot"])
    month = [PROFILE, "table_name", "month"]
    by_time = Window.partitionBy(*month).orderBy("place")
    state = F.struct("n", "digest", "place")
    before = F.lag(F.struct("n", "digest", (F.col("place") + 1).alias("place"))).over(by_time)
    same = F.coalesce(before == state, F.lit(False))
    states = states.withColumn("changed", F.when(same, 0).otherwise(1))
    states = states.withColumn("state", F.sum("changed").over(by_time))
    # groupBy on the window's keys and more: the rows of a month are already together
    states = states.groupBy(*month, "state").agg(
        F.min("snapshot").alias("snapshot"), F.min("place").alias(FIRST), F.max("place").alias(LAST)
    )
    alone = (F.count(F.lit(1)).over(Window.partitionBy(*month)) == 1).alias("alone")
    return states.select(*month, "snapshot", FIRST, LAST, alone)


def digests_of(rows: DataFrame, browser: str) -> DataFrame:
    """Digests of landed rows (profile_id, snapshot, table_name, month and the tables' structs): how many rows, a hash
    that no order of them changes, and the earliest visit."""
    family = FAMILIES[browser]
    visits, time = VISITS[browser]
    row = F.xxhash64(*family)
    return rows.where(F.col("table_name") != history_files.REJECTED).groupBy(PROFILE, "snapshot", "table_name", "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.struct(F.bit_xor(row).alias("x"), F.sum((row % 2**31).cast("bigint")).alias("s")).alias("digest"),
        F.min(F.col(f"{visits}.{time}").cast("double")).alias("earliest"),
    )


# ---- rows of several states to one history -------------------------------------


def _entities(rows: DataFrame, told: Told, keys: list[str]) -> DataFrame:
    """Each row once, in its newest version, with the first and last place it was seen at."""
    others = [c for c in rows.columns if c not in (*keys, FIRST, LAST, "alone")]

    def newest_of(some: DataFrame) -> DataFrame:
        version = F.struct(F.col(FIRST).alias("at"), *others)
        newest = some.groupBy(*keys).agg(F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST), F.max(version).alias("v"))
        return newest.select(*keys, FIRST, LAST, *(F.col(f"v.{c}").alias(c) for c in others))

    if not told.settles:
        return newest_of(rows)
    settled = rows.where("alone").select(*keys, FIRST, LAST, *others)
    return settled.unionByName(newest_of(rows.where("NOT alone")))


def _reused(entities: DataFrame, told: Told) -> DataFrame:
    """(profile_id, id, bearers): the rows that bore a reused id one after the other, with the ids they have now."""
    ids = entities.groupBy(PROFILE, "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(PROFILE, "id")
    bearers = entities.join(ids, ["id", PROFILE]).select(PROFILE, "id", FIRST, LAST, *told.by)
    age = Window.partitionBy(PROFILE, "id").orderBy(F.desc(LAST), F.desc(FIRST), *(F.desc(c) for c in told.by))
    bearers = bearers.withColumn("age", F.row_number().over(age))
    part = F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("bigint")
    older = bearers.where("age > 1").withColumn("part", part)
    number = F.row_number().over(Window.partitionBy(PROFILE, "part").orderBy("id", "age")).cast("bigint")
    older = older.withColumn("new_id", -(number * PARTS + F.col("part"))).drop("part")
    newest = bearers.where("age = 1").withColumn("new_id", F.col("id"))
    every = older.unionByName(newest)
    one = F.struct(F.col(FIRST), F.col("age"), F.col("new_id"), *told.by)
    return every.groupBy(PROFILE, "id").agg(F.sort_array(F.collect_list(one)).alias("bearers"))


def _linked(rows: DataFrame, column: str, reused: DataFrame) -> DataFrame:
    """``rows`` whose link leads to the row that bore the id when the linking row was first seen; NULL if none did."""
    found = rows.join(reused.withColumnRenamed("id", column), [column, PROFILE], "left")
    known = F.filter("bearers", lambda b: b[FIRST] <= F.col(FIRST))
    now = F.when(F.col("bearers").isNull(), F.col(column)).otherwise(F.element_at(known, -1)["new_id"])
    return found.withColumn(column, F.when(F.size(known) == 0, F.lit(None)).otherwise(now)).drop("bearers")


def _renumbered(rows: DataFrame, told: Told, reused: DataFrame) -> DataFrame:
    """``rows`` with the ids they have now."""
    found = rows.join(reused, ["id", PROFILE], "left")
    mine = F.filter("bearers", lambda b: reduce(and_, (b[c].eqNullSafe(F.col(c)) for c in told.by)))
    return found.withColumn("id", F.coalesce(F.element_at(mine, 1)["new_id"], F.col("id"))).drop("bearers")


def merged(states: Tables, browser: str) -> dict[str, DataFrame]:
    """Typed tables with ``first_seen`` and ``last_seen`` from rows of every state of every month.

    ``states`` maps table names to their rows with ``first_seen``, ``last_seen`` and ``alone`` of their state. Annotations
    and inputs are one a visit or page and term, in their newest version.
    """
    told = TOLD[browser]
    entities = {
        name: _entities(states[name], one, [PROFILE, "id", *one.by]) for name, one in told.items() if one.numbered
    }
    # few rows, which every link to the table needs
    reused = {name: kept(_reused(entities[name], told[name])) for name in entities}
    found = {}
    for name, one in told.items():
        rows = entities[name] if one.numbered else states[name]
        for column, target in one.links.items():
            rows = _linked(rows, column, reused[target])
        if one.numbered:
            rows = _renumbered(rows, one, reused[name])
        else:  # told apart by links, which had to be followed first
            rows = _entities(rows, one, [PROFILE, *one.by])
        found[name] = rows.select(PROFILE, *_columns(browser, name), FIRST, LAST)
    return found


def _columns(browser: str, table: str) -> list[str]:
    return [column.split(" ")[0] for column in FAMILIES[browser][table].split(", ")]


def tombstones(visits: DataFrame, digests: DataFrame, browser: str) -> DataFrame:
    """(profile_id, id, <time>, gone_in): the merged visits that were deleted, and the snapshot that lacks them first.

    A visit is deleted if the snapshot after the last one that holds it still has an earlier visit. One that went
    together with everything before it was dropped for its age, as was all that went with a history left empty.
    """
    _, time = VISITS[browser]
    read = digests.where(F.col("table_name") == history_files.READ).select(PROFILE, "snapshot").distinct()
    earliest = digests.groupBy(PROFILE, "snapshot").agg(F.min("earliest").alias("earliest"))
    place = F.row_number().over(Window.partitionBy(PROFILE).orderBy("snapshot")).cast("bigint")
    after = read.withColumn(LAST, place - 1).join(earliest, [PROFILE, "snapshot"])
    after = after.select(PROFILE, LAST, F.col("snapshot").alias("gone_in"), "earliest")
    gone = visits.join(after, [LAST, PROFILE]).where(F.col("earliest") < F.col(time).cast("double"))
    return gone.select(PROFILE, "id", time, "gone_in")


def history(states: Tables, digests: DataFrame, browser: str, deleted: bool = True) -> dict[str, DataFrame]:
    """Tables of the whole history, for every report; without ``deleted`` the visits of tombstones are left out."""
    tables = merged(states, browser)
    if not deleted:
        name, _ = VISITS[browser]
        gone = tombstones(tables[name], digests, browser).select(PROFILE, "id")
        tables[name] = tables[name].join(gone, ["id", PROFILE], "left_anti")
    return {name: rows.drop(FIRST, LAST) for name, rows in tables.items()}


# ---- landed snapshots ------------------------------------------------------------


def _digest_path(path: str, browser: str) -> str:
    return f"{path}/digests/browser={browser}"


def land(files: DataFrame, browser: str, path: str, snapshot: str) -> None:
    """``history_files.land``, and the digests of what was landed, from one more pass over this snapshot."""
    history_files.land(files, browser, path, snapshot)
    keep_digests(files.sparkSession, path, browser, snapshot)


def keep_digests(spark: SparkSession, path: str, browser: str, snapshot: str | None = None) -> None:
    """Write the digests of one landed snapshot, or of all."""
    rows = history_files.landed_rows(spark, path, browser)
    target = _digest_path(path, browser)
    if snapshot is None:
        digests_of(rows, browser).write.mode("overwrite").partitionBy("snapshot").parquet(target)
    else:
        digests = digests_of(rows.where(F.col("snapshot") == snapshot), browser).drop("snapshot")
        digests.write.mode("overwrite").parquet(f"{target}/snapshot={snapshot}")


def landed_digests(spark: SparkSession, path: str, browser: str) -> DataFrame:
    schema = (
        f"{PROFILE} string, table_name string, month string, n bigint, digest struct<x: bigint, s: bigint>, "
        "earliest double, snapshot string"
    )
    return spark.read.schema(schema).parquet(_digest_path(path, browser))


def landed_history(spark: SparkSession, path: str, browser: str, deleted: bool = True) -> dict[str, DataFrame]:
    """Tables of the whole history of all profiles landed with ``land`` of this module.

    Reads the digests first, to list the directories (a snapshot's months) in which some profile changed; no others
    are read.
    """
    digests = landed_digests(spark, path, browser)
    states = kept(spans(digests))
    # at most one row a directory
    changed = [r.place for r in states.select(F.concat_ws("/", "snapshot", "table_name", "month").alias("place")).distinct().collect()]
    place = F.concat_ws("/", "snapshot", "table_name", "month")
    rows = history_files.landed_rows(spark, path, browser).where(place.isin(changed))
    return history(states_of(rows, states, browser), digests, browser, deleted)


def states_of(rows: DataFrame, states: DataFrame, browser: str) -> dict[str, DataFrame]:
    """The rows of every state of every month, of landed rows of all snapshots, by table, as ``history`` takes them."""
    keys = [PROFILE, "table_name", "month", "snapshot"]
    tables = {}
    for name in FAMILIES[browser]:
        of_table = history_files.typed_rows(rows, browser, name, *keys[1:])
        tables[name] = of_table.join(states.where(F.col("table_name") == name), keys).drop(*keys[1:])
    return tables
