"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1. A source's weight changes linearly over it, from its `start` times its mean weight to
2 - `start` times that, so that by time t it has supplied the integral W(t) = start * t + (1 - start) * t^2 of its
target. Its documents, in an order fixed by a hash and repeated in passes, use up that demand one after the other: the
document whose words reach from c to c + size of a target T stands where W(t) * T is the middle of them. Sorting by
position by ranges interleaves the sources, and every pass of a document stands at a place of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.llm.common import WORD, keep, shared_folder

#: Weights of the sources by code point, repeating, and the start of each weight's schedule: light sources come early.
WEIGHTS = (1, 2, 3)
STARTS = (1.5, 1.0, 0.5)
MAX_PASSES = 3
#: Documents of a source whose sizes one task adds up, on average.
BUCKET_ROWS = 4096
#: Sources whose unused texts are left behind; of any more, which have fewer unused words, texts travel in vain.
CUT_SOURCES = 10_000


def size() -> Column:
    """Words of the text; a null text has none."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: DataFrame | None = None, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, start, target) from (source, source_size); `weights` is (source, weight, start).

    The total size is shared out by weight. A source whose share exceeds `max_passes` times its size gets that many;
    the rest is shared among the others: with sources in ascending order of limit / weight, those limited come first,
    and the first that is not sets the words per unit of weight for all that follow. One row per source passes through
    one task, never one per document.
    """
    if weights is None:
        place = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(WEIGHTS)))
        pick = lambda values: F.get(F.array(*map(F.lit, values)), place.cast("int"))
        weighted = sizes.withColumn("weight", pick(WEIGHTS)).withColumn("start", pick(STARTS))
    else:
        named = weights.select(F.col("source").alias("of"), "weight", "start")
        weighted = sizes.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    limited = weighted.withColumn("most", max_passes * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = limited.withColumn("level", (total - before).cast("double") / after).withColumn("place", F.row_number().over(order))
    free = F.when(F.col("weight") * F.col("level") < F.col("most"), F.col("place"))
    every = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = level.withColumn("shared", F.min(F.when(free.isNotNull(), F.struct("place", "level"))).over(every))
    limited_here = F.col("shared").isNull() | (F.col("place") < F.col("shared.place"))
    target = F.when(limited_here, F.col("most").cast("double")).otherwise(F.col("weight") * F.col("shared.level"))
    return shared.select("source", "source_size", "start", target.alias("target"))


def taken_in(number: Column) -> Column:
    """Words that the mix takes of a document in pass `number`, from 0."""
    left = F.floor("target") - number * F.col("source_size") - F.col("before")
    return F.least(F.greatest(left, F.lit(0)), F.col("size"))


def position(number: Column) -> Column:
    """Training time from 0 to 1 of a document in pass `number`; null in a source without words."""
    middle = number * F.col("source_size") + F.col("before") + F.col("size") / 2.0
    demand = F.least(middle / F.nullif(F.col("target"), F.lit(0.0)), F.lit(1.0))
    start = F.col("start")
    bend = F.lit(1.0) - start
    curved = (F.sqrt(start * start + 4.0 * bend * demand) - start) / F.nullif(2.0 * bend, F.lit(0.0))
    return F.when(bend == 0.0, demand).otherwise(curved)


def _measured(docs: DataFrame, *more: Column) -> DataFrame:
    order = F.md5(F.concat(F.lit("mix-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    text_key = F.xxhash64(F.coalesce("text", F.lit("")))
    source_key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    keys = [text_key.alias("text_key"), source_key.alias("source_key")]
    return docs.select("doc_id", *keys, "source", size().alias("size"), order.alias("order"), *more)


def _without_unused(rows: DataFrame, parts: DataFrame, carried: str) -> DataFrame:
    """Rows with a bucket, `carried` null where its source's target ends ahead of the bucket and the row has words.

    No pass takes any of those words. A broadcast row per source tells them, so that they are never shuffled.
    """
    used = F.col("ahead") < F.floor("target")
    ends = parts.groupBy(F.col("source_key").alias("cut_key")).agg(
        F.coalesce(F.max(F.when(used, F.col("bucket"))), F.lit(-1)).alias("last"),
        F.sum(F.when(~used, F.col("words")).otherwise(0)).alias("unused"),
    )
    ends = ends.where("unused > 0").orderBy(F.desc("unused")).limit(CUT_SOURCES).drop("unused")
    rows = rows.join(F.broadcast(ends), F.col("source_key") == F.col("cut_key"), "left")
    unused = (F.col("size") > 0) & F.coalesce(F.col("bucket") > F.col("last"), F.lit(False))
    return rows.withColumn(carried, F.when(~unused, F.col(carried))).drop("cut_key", "last")


def _placed(rows: DataFrame, carried: str, weights: DataFrame | None, max_passes: int) -> DataFrame:
    """Measured rows with `before`, the columns of their source's target, and their `place` in a bucket.

    Buckets are joined and added up by one key, which is never null, so that the rows are shuffled once. The column
    `carried` is null where whole buckets are not needed.
    """
    narrow = keep(rows.select("source", "source_key", "size", "order"))
    buckets = max(16, narrow.count() // BUCKET_ROWS)
    share = F.conv(F.substring("order", 1, 8), 16, 10).cast("bigint")
    bucket = F.floor(share * buckets / F.lit(1 << 32)).cast("int").alias("bucket")
    parts = keep(narrow.groupBy("source", "source_key", bucket).agg(F.sum("size").alias("words")))
    goals = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_passes)
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("words").over(in_source), F.lit(0)))
    goals = goals.withColumnRenamed("source", "of")
    parts = parts.join(goals, F.col("source").eqNullSafe(F.col("of"))).drop("of", "source")
    in_bucket = Window.partitionBy("source_key", "bucket").orderBy("order", "doc_id", "text_key")
    ahead = F.coalesce(F.sum("size").over(in_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = _without_unused(rows.select("*", bucket), parts, carried).join(parts.drop("words"), ["source_key", "bucket"])
    return placed.withColumn("before", F.col("ahead") + ahead).withColumn("place", F.row_number().over(in_bucket))


def _in_order(rows: DataFrame, at: Column) -> DataFrame:
    """Rows in training order: the files hold ascending ranges of positions, sorted within."""
    rows = rows.withColumn("at", F.coalesce(at, F.lit(0.0)))
    return rows.repartitionByRange("at", "order").sortWithinPartitions("at", "order").drop("at")


def pieces(docs: DataFrame, weights: DataFrame | None = None, max_passes: int = MAX_PASSES) -> DataFrame:
    """The mix in training order, to its last word: a row for every pass (`number`, from 0) that takes words of a document.

    `text` is what the pass takes: the text, or its beginning up to the last word taken, which happens to one document of
    a source. A document that the mix takes no words of is there once, with its text if it has no words and null if
    the mix has enough of its source. `position` is the pass's own. The other columns are those of `curriculum`, and
    source_key, bucket and place, which tell rows apart.
    """
    rows = _placed(_measured(docs, F.col("text")), "text", weights, max_passes)
    number = F.col("number")
    passes = F.filter(F.sequence(F.lit(0), F.lit(max_passes - 1)), lambda i: (i == 0) | (taken_in(i) > 0))
    rows = rows.withColumn("number", F.explode(passes)).withColumn("words", taken_in(number))
    spaced = F.regexp_extract_all("text", F.lit(f"([\\x20\\x09-\\x0D]*{WORD})"), F.lit(0))
    start = F.when(F.col("words") > 0, F.array_join(F.slice(spaced, F.lit(1), F.col("words").cast("int")), ""))
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(start).alias("text")
    known = ["doc_id", "source", "size", "source_size", "start", "target", "before", "source_key", "bucket", "place"]
    placed = rows.select(*known, "order", "number", position(number).alias("position"), text)
    return _in_order(placed, F.col("position")).drop("order")


def curriculum(docs: DataFrame, weights: DataFrame | None = None, max_passes: int = MAX_PASSES) -> DataFrame:
    """(doc_id, source, size, source_size, start, target, before, taken, position) of every row of `docs`.

    The mix is written in training order to the shared folder and read back: `taken` counts the words of a document's
    pieces there, and `position` is that of the first. `before` counts the words of its source ahead of a document, in
    the order of a hash of doc_id (ties by doc_id and a hash of the text). A source's taken words add up to its whole
    target, rounded down: the last pass is cut within one document. A null text has no words, null is a source of its
    own, and sources that `weights` lacks are left out. Repeated rows each count. No rows give no rows.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/mix-{uuid.uuid4()}"
    pieces(docs, weights, max_passes).write.option("compression", "zstd").parquet(folder)
    mix = spark.read.parquet(folder)
    columns = ["doc_id", "source", "size", "source_size", "start", "target", "before"]
    once = [F.max(F.when(F.col("number") == 0, F.struct(*columns, "position"))).alias("first")]
    found = mix.groupBy("source_key", "bucket", "place").agg(F.sum(size()).alias("taken"), *once)
    return found.select(*(f"first.{c}" for c in columns), "taken", "first.position")


def mixed(docs: DataFrame, weights: DataFrame | None = None, max_passes: int = MAX_PASSES) -> DataFrame:
    """The rows of `docs` in training order, each once for every pass that takes at least half of its words.

    Documents without words are taken once. The files hold ascending ranges of positions, sorted within.
    """
    rows = _placed(_measured(docs, F.struct(*docs.columns).alias("row")), "row", weights, max_passes)
    passes = F.filter(
        F.sequence(F.lit(0), F.lit(max_passes - 1)),
        lambda i: F.when(F.col("size") == 0, i == 0).otherwise(2 * taken_in(i) >= F.col("size")),
    )
    taken = rows.withColumn("number", F.explode(passes))
    return _in_order(taken.select("row", "order", position(F.col("number")).alias("position")), F.col("position")).select("row.*")
