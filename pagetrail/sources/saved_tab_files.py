"""Raw storage files of the saved-tab extension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.schemas import PROFILE


#: A file is one value, and a value is held whole by one task.
MAX_FILE_BYTES = 1 << 30


def _files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.{ldb,log}").option("ignoreCorruptFiles", True)
    return reader.load(path if isinstance(path, str) else list(path))


def oversized_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, length) of the files that ``saved_tab_files`` leaves out; no content is read for it."""
    return _files(spark, path).where(F.col("length") > MAX_FILE_BYTES).select("path", "length")


def saved_tab_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(profile_id, file_name, content) of the ``.ldb`` and ``.log`` files in storage directories.

    The profile is the directory above the extension storage. Unreadable files are skipped, and files of more than
    MAX_FILE_BYTES left out: one of them must not end the job.
    """
    files = _files(spark, path).where(F.col("length") <= MAX_FILE_BYTES)
    directory = F.regexp_replace("path", "/[^/]*$", "")
    profile = F.regexp_replace(directory, "/Local(%20| )Extension(%20| )Settings/[^/]*$", "")
    return files.select(profile.alias(PROFILE), F.substring_index("path", "/", -1).alias("file_name"), "content")
