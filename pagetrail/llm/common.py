"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space between words: space and the five control characters 9 to 13.
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def keep(frame: DataFrame) -> DataFrame:
    """The frame written once to the shared folder, so that lost executors never cost its recomputation."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """Partitions to ask for where a task computes much over few bytes, which Spark would gather in few partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: str | None) -> list[bytes]:
    """The words of a text with A-Z in lower case; bytes.split() cuts at exactly the white space that WORD excludes."""
    return (text or "").encode().lower().split()


def by_row(function: Callable[[dict], tuple], names: list[str], schema: pa.Schema, rows: int = 2048) -> Callable:
    """A mapInArrow function from one function per row, which returns a tuple in the schema's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                columns = [part.column(part.schema.get_field_index(n)).to_pylist() for n in names]
                found = [function(*row) for row in zip(*columns, strict=True)]
                if found:
                    arrays = [pa.array(c, type=f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def same(left: str, right: str):
    """Equality of two columns where null equals null."""
    return F.col(left).eqNullSafe(F.col(right))
