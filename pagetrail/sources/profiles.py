"""Choosing history databases from a listing of profile directories.

A listing has one row per file: ``root`` (a browser's base directory) and ``rel_path``
(the file below it); a root without files has one row with a NULL path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.schemas import CHROMIUM_BROWSERS

# fixed values: file names inside a profile
CHROMIUM_FILE = "History"
FIREFOX_FILE = "places.sqlite"
SAFARI_FILE = "History.db"
CHROMIUM_DEFAULT = "Default/History"
#: where a Chromium profile keeps the saved-tab extension's storage
SAVED_TABS_DIR = "Local Extension Settings/chphlpgkkbolifaimnlloiipkdnihall"

DATABASE_FILES = {
    **dict.fromkeys(CHROMIUM_BROWSERS, CHROMIUM_FILE),
    "firefox": FIREFOX_FILE,
    "safari": SAFARI_FILE,
}


def _parts(listing: DataFrame, file_name: str) -> DataFrame:
    path = F.col("rel_path")
    return listing.select(
        "root",
        path,
        F.when(F.instr(path, "/") > 0, F.substring_index(path, "/", 1)).alias("dir"),
        (F.substring_index(path, "/", -1) == file_name).alias("is_db"),
        (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).alias("depth"),
    )


def _first_dir(rank: Column) -> Column:
    """The first directory by rank then name, and whether it directly holds the database."""
    absent = F.when(F.col("is_db") & (F.col("depth") == 1), 0).otherwise(1)
    return F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), F.col("dir"), absent.alias("absent"))))


def _chosen(best: DataFrame, file_name: str, fallback: str, preferred: Column) -> DataFrame:
    """(root, db_path, found): the preferred path, else the first directory's database, else the fallback."""
    usable = F.col("first").isNotNull() & (F.col("first.absent") == 0)
    path = (
        F.when(preferred, F.lit(fallback))
        .when(usable, F.concat(F.col("first.dir"), F.lit(f"/{file_name}")))
        .otherwise(F.lit(fallback))
    )
    return best.select("root", path.alias("db_path"), (F.col("has_fallback") | usable).alias("found"))


def select_profiles(listing: DataFrame, browser: str, all_profiles: bool = False) -> DataFrame:
    """One database path per root, or every database with ``all_profiles``.

    Chromium: ``Default``, else the first ``Profile *`` directory by name. Firefox: the first
    ``*.default-release`` directory, else the first ``*.default*``. When that directory has
    no database the default path is returned with ``found = false``. Grouping reduces to one
    row per root and task, so a root with very many files is no hot spot.
    """
    if browser not in (*CHROMIUM_BROWSERS, "firefox"):
        raise ValueError(f"{browser} has no profiles: give the path of its database")
    file_name = DATABASE_FILES[browser]
    parts = _parts(listing, file_name)
    if all_profiles:
        found = parts.where(F.col("is_db") & (F.col("depth") <= 1))
        return found.select("root", F.col("rel_path").alias("db_path"), F.lit(True).alias("found"))
    name = F.col("dir")
    if browser == "firefox":
        rank = F.when(name.endswith(".default-release"), 0).when(name.contains(".default"), 1)
        fallback = FIREFOX_FILE
    else:
        rank = F.when(name.startswith("Profile "), 0)
        fallback = CHROMIUM_DEFAULT
    best = parts.groupBy("root").agg(
        _first_dir(rank).alias("first"),
        F.coalesce(F.bool_or(F.col("rel_path") == fallback), F.lit(False)).alias("has_fallback"),
    )
    preferred = F.lit(False) if browser == "firefox" else F.col("has_fallback")
    return _chosen(best, file_name, fallback, preferred)


def saved_tab_dirs(listing: DataFrame) -> DataFrame:
    """Directory of saved-tab storage per root: in ``Default``, else in the first ``Profile *`` by name."""
    name = F.col("dir")
    dirs = _parts(listing, CHROMIUM_FILE).groupBy("root").agg(
        F.coalesce(F.bool_or(name == "Default"), F.lit(False)).alias("has_default"),
        F.min(F.when(name.startswith("Profile "), name)).alias("first"),
    )
    profile = F.when(F.col("has_default") | F.col("first").isNull(), F.lit("Default")).otherwise(F.col("first"))
    return dirs.select("root", F.concat(profile, F.lit(f"/{SAVED_TABS_DIR}")).alias("dir_path"))
