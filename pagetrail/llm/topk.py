"""Exact top-k by inner product of quantised vectors, from an impact-ordered index processed score at a time.

In each dimension the vectors of a shard are posted by ascending quantised value, in segments of equal impact: bins of
values. A query walks every dimension from the end that adds most to its score, over all dimensions in descending order
of what a segment can add, and adds up the least that each segment is sure to add. What a vector can still gain is
bounded by the next segment of each dimension and by the width of the bins. It stops once few vectors can still reach
the k-th sure score; all of those are scored exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm import blocks

#: Bins of a dimension at most; a bin holds more than one value only where a dimension has more values.
BINS = 256
#: Rounds of falling impact, and the share of vectors that are few enough to be scored exactly.
ROUNDS = 8
FEW = 0.02
#: Products of vectors below this, times 256 * 256, are sums of integers that doubles hold exactly.
EXACT = 2**35
#: Scores beyond this, either way, do not fit the result.
LARGEST = 2**63 - 2


class ImpactIndex:
    """Postings of integer vectors, one row each."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.low, self.high = values.min(axis=0), values.max(axis=0)
        self.width = (self.high - self.low) // BINS + 1
        bins = (values - self.low) // self.width
        self.posted = np.argsort(bins, axis=0, kind="stable")
        self.sorted = np.take_along_axis(bins, self.posted, axis=0)
        self.posted, self.sorted = np.ascontiguousarray(self.posted.T), np.ascontiguousarray(self.sorted.T)
        self.last = (self.high - self.low) // self.width
        steps = range(values.shape[1])
        self.ends = [np.searchsorted(self.sorted[d], np.arange(self.last[d] + 2)) for d in steps]

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """Places of all vectors that can be among the k best, proven by the bounds."""
        n, dims = self.values.shape
        sure = np.zeros(n)
        weight = np.abs(query)
        used = np.flatnonzero(weight)
        slack = int((weight * (self.width - 1)).sum())
        top = weight * (self.last * self.width)
        # bins of each dimension still to come, counted from the end that adds most
        left = self.last + 1
        impact = int(top.max(initial=0))
        for step in range(ROUNDS + 1):
            impact = impact // 2 if step < ROUNDS else -1
            places, gains = [], []
            for d in used:
                # every bin that adds more than `impact` is processed
                stays = max(0, impact // int(weight[d] * self.width[d]) + 1) if impact >= 0 else 0
                stays = min(int(left[d]), stays)
                if stays < left[d]:
                    if query[d] > 0:
                        a, b = self.ends[d][stays], self.ends[d][left[d]]
                        gain = self.sorted[d, a:b]
                    else:
                        a, b = self.ends[d][self.last[d] + 1 - left[d]], self.ends[d][self.last[d] + 1 - stays]
                        gain = self.last[d] - self.sorted[d, a:b]
                    places.append(self.posted[d, a:b])
                    gains.append(gain * (weight[d] * self.width[d]))
                    left[d] = stays
            if places:
                sure += np.bincount(np.concatenate(places), np.concatenate(gains), minlength=n)
            if n <= k:
                return np.arange(n)
            open_gain = int((weight[used] * self.width[used] * np.maximum(left[used] - 1, 0)).sum()) + slack
            kth = np.partition(sure, n - k)[n - k]
            reach = np.flatnonzero(sure + open_gain >= kth)
            if len(reach) <= max(4 * k, FEW * n):
                return reach
        return reach


def wide(k: int, numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray):
    """index() for values whose products doubles may not hold: rounded scores leave out what cannot be among the k best,
    the others are scored in unlimited integers. Scores beyond LARGEST either way come out as just beyond it."""

    def integers(vector: np.ndarray) -> list[int]:
        return [256 * int(x) if abs(x) >= 2.0**53 else int(np.floor(256 * x)) for x in vector.tolist()]

    def search(number: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.flatnonzero(numbers != number)
        with np.errstate(over="ignore", invalid="ignore"):
            a, b = np.floor(256 * rows[places]), np.floor(256 * query)
            rough, off = a @ b, (np.abs(a) @ np.abs(b)) * (4 * len(query) * np.finfo(float).eps)
        if len(places) > k and np.isfinite(off).all():
            sure = rough - off
            places = places[rough + off >= np.partition(sure, len(sure) - k)[len(sure) - k]]
        exact = integers(query)
        scores = [sum(v * w for v, w in zip(integers(rows[p]), exact, strict=True)) for p in places]
        best = sorted(range(len(places)), key=lambda i: (-scores[i], ids[places[i]]))[:k]
        held = np.array([max(-LARGEST - 1, min(LARGEST + 1, scores[i])) for i in best], dtype=np.int64)
        return places[best], held

    return search


def one_by_one(search):
    return lambda numbers, queries: [search(int(n), q) for n, q in zip(numbers, queries, strict=True)]


def index(k: int) -> blocks.Index:
    def build(numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        widest = float(np.abs(rows).max(initial=0)) + 1
        others = wide(k, numbers, ids, rows)

        def fits(vector: np.ndarray) -> bool:
            return (float(np.abs(vector).max(initial=0)) + 1) * widest * rows.shape[1] < EXACT

        if not fits(rows):
            return one_by_one(others)
        values = np.floor(256 * rows).astype(np.int64)
        held = ImpactIndex(values)

        def search(number: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not fits(query):
                return others(number, query)
            query = np.floor(256 * query).astype(np.int64)
            places = held.candidates(query, k + 1)  # one may be the query itself
            places = places[numbers[places] != number]
            return blocks.top(places, values[places] @ query, ids, k)

        return one_by_one(search)

    return build


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, shard_rows: int = blocks.SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of `vectors` (vec_id, embedding): for each row whose vec_id is divisible by
    `every` the k rows other than itself with the largest integer inner product of floor(256 * x), ties to the smaller
    vec_id.

    Null vectors and ids, and vectors with null or non-finite components, take no part; vectors of another length than
    the query's are no candidates. Rows with equal ids are rows of their own. No rows give no rows. Components may be of
    any size; only a score among the k best that is beyond LARGEST is an error.
    """
    found = blocks.best(blocks.usable(vectors, nonzero=False), every, k, index(k), "bigint", shard_rows)
    fits = F.col("score").between(-LARGEST, LARGEST)
    return found.withColumn("score", F.when(fits, F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit 64 bits"))))
