import numpy as np
import pytest

from pagetrail.llm import ann, blocks, queries, topk

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, rows):
    rows = [(i, v and [None if x is None else float(x) for x in v], 0) for i, v in rows]
    return spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "number")


def plain(rows, every, k, score):
    found = set()
    for n, (i, v) in enumerate(rows):
        if i % every == 0:
            ranked = sorted((-score(v, w), j) for m, (j, w) in enumerate(rows) if m != n)[:k]
            found |= {(i, r, j, -s) for r, (s, j) in enumerate(ranked, 1)}
    return found


def integers(v, w):
    a, b = (np.floor(256 * np.array(x, dtype=np.float32).astype(float)).astype(int) for x in (v, w))
    return int(a @ b)


@pytest.mark.parametrize("scale", [0.01, 1, 500])
def test_candidates_hold_the_best(scale):
    random = np.random.default_rng(2)
    values = np.floor(scale * random.standard_normal((700, 12))).astype(np.int64)
    values[:40] = values[0]
    index = topk.ImpactIndex(values)
    for query in [*values[::70], np.zeros(12, dtype=np.int64)]:
        scores = values @ query
        kth = np.sort(scores)[-6]
        assert set(np.flatnonzero(scores >= kth)) <= set(index.candidates(query, 6))


def test_proof_stops_early():
    random = np.random.default_rng(4)
    centres = random.standard_normal((20, 16)) * 80
    values = np.floor(centres[np.arange(2000) % 20] + random.standard_normal((2000, 16)) * 3).astype(np.int64)
    assert len(topk.ImpactIndex(values).candidates(values[5], 6)) < 300


def test_exact_top_k(spark):
    random = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in random.standard_normal(6).astype(np.float32)]) for i in random.permutation(230)]
    rows += [(50, rows[0][1]), (51, rows[0][1]), (50, rows[0][1])]
    odd = [(100, None), (7, [1.0, None, 0, 0, 0, 0]), (8, [float("nan")] * 6), (9, [float("inf")] * 6), (None, [1.0] * 6)]
    found = topk.top_k(table(spark, rows + odd + [(1000, [1.0, 2.0])]), shard_rows=60)
    assert {tuple(r) for r in found.collect()} == plain(rows, 50, 5, integers)
    few = topk.top_k(table(spark, rows[:3] + [(0, rows[9][1])]))
    assert few.count() == 3 * sum(i % 50 == 0 for i, _ in [*rows[:3], (0, 0)])
    assert topk.top_k(table(spark, []), 50).collect() == []


def test_whole_share_is_exact(spark):
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in (random.standard_normal(5) * (1 + i % 3)).astype(np.float32)]) for i in range(150)]
    found = ann.nearest(table(spark, [*rows, (40, [0.0] * 5), (60, None)]), share=1.0, shard_rows=40).collect()
    expected = plain(rows, 20, 20, lambda v, w: sum(a * b for a, b in zip(v, w, strict=True)))
    assert {r[:3] for r in found} == {r[:3] for r in expected}
    assert ann.nearest(table(spark, [])).collect() == []


def recall(rows, asked, k=20):
    """The share of the true nearest that a shard's index finds."""
    places, asked = np.arange(len(rows)), np.array(asked)
    search = ann.index(k, float(np.sqrt((rows**2).sum(axis=1)).max()), ann.SHARE)(places, places, rows)
    hits = 0
    for start in range(0, len(asked), blocks.QUERIES):
        some = asked[start : start + blocks.QUERIES]
        for q, (found, scores) in zip(some, search(some, rows[some]), strict=True):
            every = rows @ rows[q]
            every[q] = -np.inf
            hits += len(np.intersect1d(found, np.argsort(-every)[:k]))
            assert q not in found and (np.diff(scores) <= 0).all()
    return hits / (len(asked) * k)


@pytest.mark.parametrize("size", [2, 22, 60, 500])
def test_small_shards_are_hashed_too(size):
    random = np.random.default_rng(size)
    rows = random.standard_normal((size, 64))
    assert recall(rows, range(0, size, 7), min(20, size - 1)) >= 0.9
    if size == 500:
        longest = float(np.sqrt((rows**2).sum(axis=1)).max())
        band = ann.Band(np.arange(size), rows, longest, ann.SHARE, 20)
        assert len(band.tables.tables) == ann.TABLES and band.share < 0.9


def test_clustered_vectors_need_a_small_share():
    random = np.random.default_rng(2)
    centres = random.standard_normal((100, 64))
    rows = centres[np.arange(4000) % 100] + 0.1 * random.standard_normal((4000, 64))
    rows /= np.sqrt((rows**2).sum(axis=1))[:, None]
    assert ann.Band(np.arange(4000), rows, 1.0, ann.SHARE, 20).share < 0.03
    assert recall(rows, range(0, 400, 10)) >= 0.9


def test_recall_of_a_large_shard():
    random = np.random.default_rng(8)
    rows = random.standard_normal((8192, 64))
    rows /= np.sqrt((rows**2).sum(axis=1))[:, None]
    assert recall(rows, range(0, 400, 10)) >= 0.9


def test_recall(spark):
    sf = "/root/testdata/sf0.01"
    found = {(r.query_id, r.vec_id) for r in queries.nearest_vectors(spark, sf).collect()}
    data = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    rows = [(r.vec_id, np.array(r.embedding)) for r in data]
    exact = {(q, j) for q, _, j, _ in plain(rows, 20, 20, lambda v, w: float(v @ w))}
    assert len(found) == len(exact) and len(found & exact) >= 0.9 * len(exact)


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert {tuple(r) for r in queries.top_vectors(spark, sf).collect()} == plain(rows, 50, 5, integers)
    assert blocks.SHARD_ROWS > 0


def test_large_components(spark):
    random = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in random.standard_normal(64).astype(np.float32)]) for i in range(120)]
    for at, large in ((50, 1e6), (7, -3e6), (33, 1e9)):
        rows[at][1][at % 64] = large
    found = topk.top_k(table(spark, rows), shard_rows=40).collect()
    assert {tuple(r) for r in found} == plain(rows, 50, 5, lambda v, w: sum(int(np.floor(256 * a)) * int(np.floor(256 * b)) for a, b in zip(np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float))))


@pytest.mark.parametrize("spread", ["one of twice the length", "one of four times", "lognormal", "within a band"])
def test_recall_of_unequal_lengths(spread):
    random = np.random.default_rng(12)
    rows = random.standard_normal((8192, 64))
    rows /= np.sqrt((rows**2).sum(axis=1))[:, None]
    if spread == "lognormal":
        rows *= random.lognormal(size=(len(rows), 1))
    elif spread == "within a band":
        rows *= random.uniform(0.82, 1, size=(len(rows), 1))
    else:
        rows[4321] *= 2 if "twice" in spread else 4
    assert recall(rows, range(0, 800, 20)) >= 0.9
