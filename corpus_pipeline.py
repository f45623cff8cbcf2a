"""The corpus pipeline: documents without toxic texts, repeated lines and near copies, mixed and encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet and reads again as the
next stage's docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pagetrail.llm import bpe, linededup, mixing, simhash, toxicity
from pagetrail.llm.common import shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a classifier trained on the labelled ones does not predict to be toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that repeat an earlier one."""
    return linededup.without_repeats(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, each as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of each row, and the text that these decode to."""
    return bpe.with_texts(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("simhash near-dedup", drop_copies),
    ("mixing", mix),
    ("byte-level BPE", encode),
]
#: Trained scores, edit joins and components are not SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
