"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of TABLES tables hashes a vector by HASHES Gaussian projections, cut into slots of WIDTH. Inner products become
distances by one more component that gives every candidate the length of the longest, and queries, scaled to that length
too, a zero. Where lengths differ, that component would swamp the others, so vectors are cut into bands of like length,
each with tables and a longest of its own.

A query's place within its slots tells how far it is from the slots beside them, so every occupied bucket has an estimate
of how likely it holds near vectors: the squared distances to the slots that it differs in. Buckets are probed in that
order, in all tables at once: a vector comes up the earlier, the nearer its buckets are together. Probing goes on until a
share of the band has come up that some of the shard's own vectors, taken as queries, needed to find RECALL of their
nearest. The merged candidates are ranked by their exact inner products. Bands follow by descending length until no
vector of the next can reach the k-th best. Queries are hashed, and their buckets estimated, in blocks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm import blocks

TABLES, HASHES, WIDTH, SEED = 16, 5, 1.0, 11
#: Share of a band that is probed at least; vectors without clusters need more.
SHARE = 0.01
#: Vectors of a band are shorter than its longest by less than this factor.
BAND = 1.25
#: Share of their nearest that SAMPLES of a band's vectors find in it.
RECALL, SAMPLES = 0.975, 64


class Tables:
    """Hash tables over the rows of a matrix whose lengths are at most `longest`."""

    def __init__(self, rows: np.ndarray, longest: float, tables: int = TABLES) -> None:
        random = np.random.default_rng(SEED)
        dims = rows.shape[1] + 1
        rest = np.sqrt(np.maximum(longest**2 - (rows**2).sum(axis=1), 0))
        points = np.column_stack([rows, rest]) / longest
        self.size, self.tables = len(rows), []
        for _ in range(tables):
            lines = random.standard_normal((dims, HASHES)) / WIDTH
            shift = random.uniform(0, 1, HASHES)
            slots = np.floor(points @ lines + shift).astype(np.int64)
            low, high = slots.min(axis=0), slots.max(axis=0)
            # a bucket as one number; points are no longer than 1, so its slots are few
            steps = np.cumprod([1, *(high - low + 1)[:-1]])
            _, first, owner = np.unique((slots - low) @ steps, return_index=True, return_inverse=True)
            self.tables.append((lines[:-1], shift, low, high, (slots[first] - low).T.copy(), owner.reshape(-1)))

    def estimates(self, queries: np.ndarray) -> np.ndarray:
        """[query, vector]: how far the vector's buckets are from the query, added up over the tables."""
        points = queries / np.sqrt((queries**2).sum(axis=1))[:, None]
        estimate = np.zeros((len(queries), self.size), dtype=np.float32)
        for lines, shift, low, high, slots, owner in self.tables:
            place = points @ lines + shift
            total = np.zeros((len(queries), slots.shape[1]), dtype=np.float32)
            for h in range(HASHES):
                edge = np.arange(low[h], high[h] + 1)  # the lower edge of each slot in use
                away = np.maximum(np.maximum(edge - place[:, h, None], place[:, h, None] - edge - 1), 0)
                total += (away * away).astype(np.float32)[:, slots[h]]
            estimate += total[:, owner]
        return estimate


class Band:
    """Places of a shard's vectors of like length."""

    def __init__(self, places: np.ndarray, rows: np.ndarray, longest: float, share: float, k: int) -> None:
        self.places, self.rows, self.longest, self.share = places, rows[places], longest, share
        if share < 1:
            self.tables = Tables(self.rows, longest)
            self.share = max(share, self._needed(k))

    def _needed(self, k: int) -> float:
        """The share to probe so that sample vectors find RECALL of their k nearest others in the band."""
        size = len(self.rows)
        if size <= k + 1:
            return 1.0
        samples = np.unique(np.linspace(0, size - 1, min(SAMPLES, size)).astype(np.int64))
        scores = self.rows[samples] @ self.rows.T
        scores[np.arange(len(samples)), samples] = -np.inf
        nearest = np.argpartition(scores, size - k, axis=1)[:, size - k :]
        estimate = self.tables.estimates(self.rows[samples])
        found = np.take_along_axis(estimate, nearest, axis=1)
        ranks = [np.searchsorted(np.sort(e), f, side="right") for e, f in zip(estimate, found, strict=True)]
        return float(np.quantile(np.concatenate(ranks) / size, RECALL))

    def candidates(self, queries: np.ndarray) -> list[np.ndarray]:
        """Places in the band of the vectors that come up first for each query."""
        size = len(self.rows)
        wanted = int(np.ceil(self.share * size))
        if wanted >= size:  # every occupied bucket is probed
            return [np.arange(size)] * len(queries)
        estimate = self.tables.estimates(queries)
        limits = np.partition(estimate, wanted - 1, axis=1)[:, wanted - 1]
        return [np.flatnonzero(e <= limit) for e, limit in zip(estimate, limits, strict=True)]


def index(k: int, longest: float, share: float) -> blocks.Index:
    def build(numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        lengths = np.sqrt((rows**2).sum(axis=1))
        band = np.floor(np.log(np.maximum(longest / lengths, 1)) / np.log(BAND))
        bands = []
        for number in np.unique(band):
            places = np.flatnonzero(band == number)
            bands.append(Band(places, rows, float(lengths[places].max()), share, k))

        def search(asked: np.ndarray, queries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
            found = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in asked]
            size = np.sqrt((queries**2).sum(axis=1))
            for held in bands:
                # no score of a band exceeds the product of the lengths
                open_ = [
                    i for i, (places, scores) in enumerate(found)
                    if len(places) < k or scores.min() <= size[i] * held.longest * (1 + 1e-9) + 1e-9
                ]
                if not open_:
                    break
                for i, more in zip(open_, held.candidates(queries[open_]), strict=True):
                    score = held.rows[more] @ queries[i]
                    more = held.places[more]
                    other = numbers[more] != asked[i]
                    places, scores = np.concatenate([found[i][0], more[other]]), np.concatenate([found[i][1], score[other]])
                    if len(places) > k:
                        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                        stays = scores >= kth - 1e-9 * (1 + abs(kth))
                        places, scores = places[stays], scores[stays]
                    found[i] = places, scores
            # the sum over components in order, so that a score does not depend on the shard
            exact = [np.cumsum(rows[places] * query, axis=1)[:, -1] for (places, _), query in zip(found, queries, strict=True)]
            return [blocks.top(places, scores, ids, k) for (places, _), scores in zip(found, exact, strict=True)]

        return search

    return build


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, share: float = SHARE, shard_rows: int = blocks.SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of `vectors` (vec_id, embedding): for each row whose vec_id is divisible by
    `every` the k rows other than itself with the largest inner products found, ties to the smaller vec_id.

    Null ids and null or zero vectors, and vectors with null or non-finite components, take no part; vectors of another
    length than the query's are no candidates. Every vector is indexed. Rows with equal ids are rows of their own. With
    `share` 1 the result is exact. No rows give no rows.
    """
    rows = blocks.usable(vectors, nonzero=True)
    square = F.aggregate("vector", F.lit(0.0), lambda total, v: total + v * v)
    longest = rows.agg(F.max(square)).first()[0]
    return blocks.best(rows, every, k, index(k, float(np.sqrt(longest or 1.0)), share), "double", shard_rows)
