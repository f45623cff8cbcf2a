"""Results that several parts of a plan use, written once to the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the one the session was given for checkpoints.

    Only a local session without either gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pagetrail-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def kept(frame: DataFrame) -> DataFrame:
    """The frame, computed now and once; lost executors do not cost its recomputation."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)
