"""A query set against all vectors, shard by shard.

Vectors are spread over shards of about SHARD_ROWS; every query goes to every shard. A task reads the vectors of a shard
first, builds what index it wants of them, and then streams the queries past it. Each shard's best are merged by a
ranking window, which drops all but the best before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.llm.common import keep

SHARD_ROWS = 8192

#: Queries that a shard is asked at a time.
QUERIES = 64

#: Given the numbers, ids and rows of a shard, a function from the numbers and rows of queries to (places, scores) of each.
Found = list[tuple[np.ndarray, np.ndarray]]
Index = Callable[[np.ndarray, np.ndarray, np.ndarray], Callable[[np.ndarray, np.ndarray], Found]]


def usable(vectors: DataFrame, nonzero: bool) -> DataFrame:
    """(number, vec_id, vector) of the vectors without null or non-finite components, as doubles, numbered by row."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~odd)
    if nonzero:
        rows = rows.where(F.exists("embedding", lambda v: v != 0))
    return keep(rows.select(F.monotonically_increasing_id().alias("number"), "vec_id", x.alias("vector")))


def _search(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Batches of (shard, is_query, dimensions, number, vec_id, vector), sorted by the first two."""
    at: tuple | None = None
    rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    search = None
    for batch in batches:
        shard, query, dims, number, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        vectors = batch.column(5)
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        offset = np.concatenate([[0], np.cumsum(dims)])
        key = np.stack([shard, query.astype(np.int64), dims])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            here = (int(shard[a]), int(dims[a]))
            if here != at:
                at, rows, search = here, [], None
            part = flat[offset[a] : offset[b]].reshape(b - a, dims[a])
            if not query[a]:
                rows.append((number[a:b], ids[a:b], part))
                continue
            if not rows:
                continue
            if search is None:
                numbers, names, matrix = (np.concatenate(x) for x in zip(*rows, strict=True))
                search = index(numbers, names, matrix)
            for start in range(a, b, QUERIES):
                some = slice(start, min(b, start + QUERIES))
                found = search(number[some], part[some.start - a : some.stop - a])
                times = [len(p) for p, _ in found]
                places = np.concatenate([p for p, _ in found]).astype(np.int64)
                arrays = [
                    pa.array(np.repeat(number[some], times)),
                    pa.array(np.repeat(ids[some], times)),
                    pa.array(names[places]),
                    pa.array(np.concatenate([s for _, s in found])),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["number", "query_id", "vec_id", "score"])


def best(rows: DataFrame, every: int, k: int, index: Index, score_type: str, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of the others for each row whose vec_id is divisible by `every`.

    `rows` are usable() vectors. Only vectors of the query's length are compared.
    """
    rows = rows.withColumn("dimensions", F.size("vector").cast("bigint"))
    shards = max(1, -(-rows.count() // shard_rows))
    spread = rows.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)).cast("int"))
    queries = rows.where(F.col("vec_id") % every == 0)
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    columns = [F.col("shard"), "is_query", "dimensions", "number", F.col("vec_id").cast("bigint").alias("vec_id"), "vector"]
    both = spread.withColumn("is_query", F.lit(False)).select(*columns)
    both = both.union(queries.withColumn("is_query", F.lit(True)).select(*columns))
    order = ["shard", "dimensions", "is_query"]
    near = (
        both.repartitionById(shards, F.col("shard"))  # one shard a task
        .sortWithinPartitions(*order)
        .mapInArrow(lambda b: _search(b, index), f"number bigint, query_id bigint, vec_id bigint, score {score_type}")
    )
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "vec_id"))
    ranked = near.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top(places: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of the given places, ties to the smaller id."""
    order = np.lexsort((ids[places], -scores))[:k]
    return places[order], scores[order]
