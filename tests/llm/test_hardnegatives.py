import numpy as np
import pytest

from pagetrail.llm import hardnegatives as hard

SCHEMA = "vec_id bigint, embedding array<double>, label int, number string, shard int"


def table(spark, rows):
    rows = [(i, v and [None if x is None else float(x) for x in v], y, "n", 0) for i, v, y in rows]
    return spark.createDataFrame(rows, SCHEMA)


def whole(v):
    return [256 * int(x) if abs(x) >= 2**53 else int(np.floor(256 * x)) for x in v]


def plain(rows, every, k, n, percent):
    rows = [(i, whole(v), y, place) for place, (i, v, y) in enumerate(rows)]
    found = []
    for i, v, y, place in rows:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, at, z) for j, w, z, at in rows if at != place and len(w) == len(v)]
        scored.sort()
        for s, j, _, _ in [x for x in scored if x[3] == y][:k]:
            inside = [x for x in scored if x[3] != y and percent * -s <= 100 * -x[0] <= 100 * -s]
            found += [(i, j, r, x[1], -s, -x[0]) for r, x in enumerate(inside[:n], 1)]
    return sorted(found)


def rows_of(random, count, dims, labels, scale=1.0):
    near = random.standard_normal((5, dims))
    return [
        (int(i), (scale * (near[i % 5] + 0.7 * random.standard_normal(dims))).tolist(), int(random.integers(labels)))
        for i in random.permutation(count)
    ]


@pytest.mark.parametrize("scale", [1e-3, 0.1, 30.0, 1e8, 1e60, 1e250])
@pytest.mark.parametrize("dims", [1, 64, 200])
def test_scores_are_exact(scale, dims):
    random = np.random.default_rng(5)
    vectors = scale * random.standard_normal((40, dims))
    shard = hard.Shard(np.arange(40), np.arange(40), np.zeros(40), vectors)
    assert shard.scores(vectors[:7]).tolist() == [
        [sum(a * b for a, b in zip(whole(v), whole(w), strict=True)) for w in vectors] for v in vectors[:7]
    ]


def test_float32_sums_are_exact():
    largest = max(hard.PRIMES) // 2
    assert hard.COLUMNS * largest**2 < 2**24


@pytest.mark.parametrize("scale", [0.2, 1e5])
def test_mined(spark, scale):
    random = np.random.default_rng(1)
    rows = rows_of(random, 260, 6, 3, scale)
    rows += [(50, rows[0][1], 0), (51, rows[0][1], 1), (50, rows[0][1], 0), (100, [0.0] * 6, 1), (100, [1.0, 2.0], 1), (3, [1.0, 2.0], 1)]
    rows += [(7, [1.0, 2.0], 2)]
    odd = [(100, None, 1), (100, [1.0] * 6, None), (None, [1.0] * 6, 1), (0, [None] * 6, 1), (8, [float("nan")] * 6, 1)]
    odd += [(9, [float("inf")] * 6, 1)]
    found = hard.mined(table(spark, rows + odd), every=10, positives=4, negatives=3, shard_rows=70)
    assert sorted(map(tuple, found.collect())) == plain(rows, 10, 4, 3, 80)
    assert len(plain(rows, 10, 4, 3, 80)) > 100


def test_few_rows(spark):
    assert hard.mined(table(spark, [])).collect() == []
    assert hard.mined(table(spark, [(0, [1.0], 1), (1, [1.0], 1)])).collect() == []
    found = hard.mined(table(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)])).collect()
    assert list(map(tuple, found)) == [(0, 1, 1, 2, 65536, 256 * 230)]
    empty = [(0, [], 1), (1, [], 1), (2, [], 2)]
    assert list(map(tuple, hard.mined(table(spark, empty)).collect())) == [(0, 1, 1, 2, 0, 0)]


def test_scores_beyond_64_bits(spark):
    rows = [(0, [1e3], 1), (1, [1e3], 1), (2, [0.9e3], 2), (3, [-1e200], 2)]
    assert list(map(tuple, hard.mined(table(spark, rows)).collect())) == plain(rows, 100, 5, 5, 80)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        hard.mined(table(spark, [(0, [1e10], 1), (1, [1e10], 1)])).collect()
