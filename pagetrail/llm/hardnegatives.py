"""Hard negatives by exact integer products in a residue number system.

Components are turned into integers. Modulo a prime below 1024, a block of COLUMNS components has products whose sums a
float32 holds exactly, so the residues of all scores come from float32 matrix products, one per prime. As many primes
are used as the lengths of the vectors demand; mixed-radix digits (Chinese remaindering) give the signed scores back.

Rows are spread over shards, and every anchor goes to every shard. A first pass merges each anchor's best rows of its own
label, its positives; a second one selects, for each positive, the best rows of other labels in a window below its score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.llm.common import keep

#: Rows of a shard, anchors multiplied at a time, and components whose products a float32 sums exactly.
SHARD_ROWS, ANCHORS, COLUMNS = 16_384, 64, 64
#: Results beyond this, either way, do not fit.
LARGEST = 2**63 - 1


def _primes(below: int) -> list[int]:
    """The primes from the greatest down."""
    sieve = np.ones(below, dtype=bool)
    sieve[:2] = False
    for n in range(2, int(below**0.5) + 1):
        if sieve[n]:
            sieve[n * n :: n] = False
    return np.flatnonzero(sieve)[::-1].tolist()


#: Half a prime squared, COLUMNS times, is below 2 ** 24.
PRIMES = _primes(1024)


def chosen_primes(bound: int) -> list[int] | None:
    """As many primes as tell all integers up to `bound`, either way, apart; None if all do not."""
    product = 1
    for count, prime in enumerate(PRIMES, 1):
        product *= prime
        if product > 2 * bound + 1:
            return PRIMES[:count]
    return None


def residues(values: np.ndarray, prime: int) -> np.ndarray:
    """The whole numbers of doubles modulo a prime, nearest to zero; exact for doubles of any size."""
    rest = np.fmod(values, prime)
    half = prime // 2
    return (rest - prime * ((rest > half).astype(float) - (rest < -half))).astype(np.float32)


def residue_products(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """The residues of a @ b.T, both residues, from 0 to prime - 1."""
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    for start in range(0, a.shape[1], COLUMNS):
        block = a[:, start : start + COLUMNS] @ b[:, start : start + COLUMNS].T
        total += block.astype(np.int64)
    return total % prime


def reconstructed(rests: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed integers nearest to zero with these residues, as int64 or, where that may not do, Python integers."""
    product = 1
    for prime in primes:
        product *= prime
    wide = product >= 2**62
    digits: list[np.ndarray] = []
    for n, prime in enumerate(primes):
        # the digit of prime n: what is left of the residue after the digits before it, divided by their primes
        value, weight = np.zeros_like(rests[n]), 1
        for digit, before in zip(digits, primes, strict=False):
            value += digit * weight
            weight = weight * before % prime
        digits.append((rests[n] - value) % prime * pow(weight, -1, prime) % prime)
    total, weight = digits[0].astype(object) if wide else digits[0].copy(), 1
    for digit, before in zip(digits[1:], primes, strict=False):
        weight *= before
        total = total + (digit.astype(object) if wide else digit) * weight
    return np.where(total > product // 2, total - product, total)


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) as Python integers, whatever the size of x."""
    return np.array([256 * int(x) if abs(x) >= 2.0**53 else int(np.floor(256 * x)) for x in vectors.flat], dtype=object).reshape(vectors.shape)


class Shard:
    """Rows of one length whose scores with any anchors are worked out exactly."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort((numbers, ids))  # places follow the ids, so that the smaller place wins a tie
        self.numbers, self.ids, self.labels, self.vectors = numbers[order], ids[order], labels[order], vectors[order]
        self.longest = _longest(vectors)
        self.held: dict[int, np.ndarray] = {}

    def _rests(self, prime: int) -> np.ndarray:
        if prime not in self.held:
            self.held[prime] = residues(np.floor(256 * self.vectors), prime)
        return self.held[prime]

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        # no product of two vectors exceeds the product of their lengths
        primes = chosen_primes(self.longest * _longest(anchors))
        if primes is None:
            return integers(anchors) @ integers(self.vectors).T
        whole = np.floor(256 * anchors)
        return reconstructed([residue_products(residues(whole, p), self._rests(p), p) for p in primes], primes)

    def best(self, scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of scores, place) of the k greatest allowed scores of each row, ties to the smaller place."""
        size = scores.shape[1]
        if scores.dtype != object and np.abs(scores).max(initial=0) < 2**62 // size:
            key = np.where(allowed, scores * size - np.arange(size), np.iinfo(np.int64).min)
            if size > k:
                places = np.argpartition(key, size - k, axis=1)[:, size - k :]
            else:
                places = np.tile(np.arange(size), (len(key), 1))
            row, column = np.nonzero(np.take_along_axis(allowed, places, axis=1))
            return row, places[row, column]
        rows, found = [], []
        for row in range(len(scores)):
            places = sorted(np.flatnonzero(allowed[row]).tolist(), key=lambda p: (-int(scores[row, p]), p))[:k]
            rows += [row] * len(places)
            found += places
        return np.array(rows, dtype=np.int64), np.array(found, dtype=np.int64)


def _longest(vectors: np.ndarray) -> int:
    """No vector of floor(256 * x) is longer."""
    most = float(np.abs(vectors).max(initial=0))
    if not most:
        return 0
    scaled = float(np.sqrt(((vectors / most) ** 2).sum(axis=1).max())) * (1 + 1e-9)
    # each component may be lower by 1
    return (int(most) + 1) * (int(256 * scaled) + 1) + vectors.shape[1] if most >= 2.0**40 else int(256 * most * scaled) + 1 + vectors.shape[1]


#: Given a shard and anchors (numbers, ids, labels, values, windows), the rows of a batch as arrays.
Select = Callable[[Shard, tuple[np.ndarray, ...]], list[np.ndarray]]


def _fits(scores: np.ndarray) -> np.ndarray:
    if len(scores) and max(map(int, (scores.max(), -scores.min()))) > LARGEST:
        raise ValueError("a score does not fit 64 bits")
    return scores.astype(np.int64)


def _search(batches: Iterator[pa.RecordBatch], select: Select, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of (shard, dimensions, is_anchor, number, vec_id, label, vector, at_most), sorted by the first three."""
    at: tuple | None = None
    rows: list[tuple[np.ndarray, ...]] = []
    shard = None
    for batch in batches:
        first, dims, anchor, number, ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        flat = batch.column(6).flatten().to_numpy(zero_copy_only=False)
        window = batch.column(7)
        offset = np.concatenate([[0], np.cumsum(dims)])
        changed = (first[1:] != first[:-1]) | (dims[1:] != dims[:-1]) | (anchor[1:] != anchor[:-1])
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            here = (int(first[a]), int(dims[a]))
            if here != at:
                at, rows, shard = here, [], None
            values = flat[offset[a] : offset[b]].reshape(b - a, dims[a])
            if not anchor[a]:
                rows.append((number[a:b], ids[a:b], labels[a:b], values))
                continue
            if not rows:
                continue
            if shard is None:
                shard = Shard(*(np.concatenate(x) for x in zip(*rows, strict=True)))
            for start in range(a, b, ANCHORS):
                part = slice(start, min(b, start + ANCHORS))
                some = (number[part], ids[part], labels[part], values[part.start - a : part.stop - a], window[part].to_pylist())
                found = select(shard, some)
                if len(found[0]):
                    arrays = [pa.array(x, type=f.type) for x, f in zip(found, schema, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _positives(k: int) -> Select:
    def select(shard: Shard, anchors: tuple) -> list[np.ndarray]:
        number, ids, labels, values, _ = anchors
        scores = shard.scores(values)
        allowed = (shard.labels == labels[:, None]) & (shard.numbers != number[:, None])
        row, place = shard.best(scores, allowed, k)
        return [number[row], shard.numbers[place], shard.ids[place], _fits(scores[row, place])]

    return select


def _negatives(k: int, percent: int) -> Select:
    def select(shard: Shard, anchors: tuple) -> list[np.ndarray]:
        number, _, labels, values, windows = anchors
        scores = shard.scores(values)
        other = shard.labels != labels[:, None]
        if np.abs(scores).max(initial=0) >= 2**55:  # a hundred times that may not fit
            scores = scores.astype(object)
        rows, tops = zip(*[(row, top) for row, held in enumerate(windows) for top in held], strict=True)
        out: list[list[np.ndarray]] = []
        for start in range(0, len(rows), ANCHORS):
            row, top = np.array(rows[start : start + ANCHORS]), np.array(tops[start : start + ANCHORS])
            some, most = scores[row], (top.astype(object) if scores.dtype == object else top)[:, None]
            allowed = other[row] & (some <= most) & (100 * some >= percent * most)
            at, place = shard.best(some, allowed.astype(bool), k)
            out.append([number[row[at]], top[at], shard.numbers[place], shard.ids[place], some[at, place].astype(np.int64)])
        return [np.concatenate(x) for x in zip(*out, strict=True)]

    return select


def _pass(rows: DataFrame, anchors: DataFrame, shards: int, select: Select, schema: str, arrow: pa.Schema) -> DataFrame:
    """`select` over every shard with all anchors, whose at_most are the tops of their windows."""
    spread = rows.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)).cast("int"))
    spread = spread.withColumn("at_most", F.array().cast("array<bigint>")).withColumn("is_anchor", F.lit(False))
    copies = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("is_anchor", F.lit(True))
    columns = ["shard", "dimensions", "is_anchor", "number", "vec_id", "label", "vector", "at_most"]
    both = spread.select(*columns).union(copies.select(*columns))
    # one shard per partition
    placed = both.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "dimensions", "is_anchor")
    return placed.mapInArrow(lambda b: _search(b, select, arrow), schema)


def _arrow(names: list[str]) -> tuple[str, pa.Schema]:
    return ", ".join(f"{n} bigint" for n in names), pa.schema([(n, pa.int64()) for n in names])


def mined(
    vectors: DataFrame, label: Column | None = None, every: int = 100, positives: int = 5, negatives: int = 5,
    percent: int = 80, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of `vectors` (vec_id, embedding, label).

    Components become floor(256 * x); a score is the integer inner product. Anchors are the rows whose vec_id is divisible
    by `every`; an anchor's positives are its best other rows of the same label, `positives` of them at most. For each, the
    best `negatives` rows of another label, with scores from `percent` % of the positive's up to it, are returned in
    order. Higher scores come first, ties to the smaller vec_id.

    Rows with a null vec_id, vector or label, or a null or non-finite component take no part, and vectors of another
    length than the anchor's are not compared. Rows with equal ids are rows of their own, so a pair of ids can come more
    than once. `label` may replace the column. Empty vectors score 0. No rows give no rows. A score that the result
    would hold and that is beyond 64 bits is an error.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    known = vectors.withColumn("label", F.col("label") if label is None else label)
    known = known.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~odd)
    rows = keep(
        known.select(
            F.monotonically_increasing_id().alias("number"),
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("label").cast("bigint").alias("label"),
            F.size("embedding").cast("bigint").alias("dimensions"),
            x.alias("vector"),
        )
    )
    shards = max(1, -(-rows.count() // shard_rows))
    anchors = rows.where(F.col("vec_id") % every == 0)
    names, arrow = _arrow(["number", "positive", "positive_id", "positive_score"])
    near = _pass(rows, anchors.withColumn("at_most", F.array().cast("array<bigint>")), shards, _positives(positives), names, arrow)
    order = Window.partitionBy("number").orderBy(F.desc("positive_score"), "positive_id", "positive")
    ranked = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    ranked = keep(ranked)
    # equal scores of one anchor have one window
    tops = ranked.groupBy("number").agg(F.collect_set("positive_score").alias("at_most"))
    names, arrow = _arrow(["number", "positive_score", "negative", "negative_id", "negative_score"])
    chosen = _pass(rows, anchors.join(tops, "number"), shards, _negatives(negatives, percent), names, arrow)
    order = Window.partitionBy("number", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "negative")
    chosen = chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    pairs = ranked.join(chosen, ["number", "positive_score"])
    pairs = pairs.join(anchors.select("number", F.col("vec_id").alias("anchor_id")), "number")
    return pairs.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

