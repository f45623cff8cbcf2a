import math

import duckdb
import pytest

from pagetrail.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def shared_out(sizes):
    """Targets by sharing again and again: (source, size) -> target."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    limited, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in limited]
        left = total - sum(limited.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] >= 3 * sizes[s]]
        if not over:
            return limited | share
        limited |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [[5, 900, 3, 50, 70], [10], [0, 4], [0, 0], [1, 1, 1, 1000], [7, 7, 7, 7, 7, 7]])
def test_targets(spark, sizes):
    names = ["a", "B", "é", "z", "c", None][-len(sizes) :]
    known = dict(zip(names, sizes, strict=True))
    found = mixing.targets(spark.createDataFrame(list(known.items()), "source string, source_size bigint"))
    expected = shared_out(known)
    for row in found.collect():
        assert math.isclose(row.target, expected[row.source], abs_tol=1e-6)


def test_positions_follow_schedule(spark, documents):
    docs = documents([(i, "w " * 10) for i in range(300)], "a")
    docs = docs.union(documents([(i, "w " * 10) for i in range(300, 600)], "b"))
    weights = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 0.0)], "source string, weight int, start double")
    rows = mixing.curriculum(docs, weights).collect()
    for source, integral in (("a", lambda t: 2 * t - t * t), ("b", lambda t: t * t)):
        own = [r for r in rows if r.source == source]
        for t in (0.2, 0.5, 0.9):
            share = sum(r.size for r in own if r.position <= t) / 3000
            assert abs(share - integral(t)) < 0.01


def test_taken_and_mixed(spark, documents):
    docs = documents([(i, "one two three four " * (i % 7)) for i in range(40)], "a")
    docs = docs.union(documents([(100 + i, "few words") for i in range(10)] + [(None, "a b"), (7, None)], "b"))
    docs = docs.union(documents([(200, "x " * 999), (200, "x " * 999)], None)).withColumnRenamed("lang", "size")
    rows = mixing.curriculum(docs).collect()
    goals = {r.source: r.target for r in rows}
    for source, goal in goals.items():
        assert sum(r.taken for r in rows if r.source == source) == math.floor(goal)
    assert all(0 <= r.taken <= 3 * r.size for r in rows) and len(rows) == docs.count()
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    out = mixed.collect()
    for source, goal in goals.items():
        largest = max(r.size for r in rows if r.source == source)
        assert abs(sum(len((r.text or "").split()) for r in out if r.source == source) - goal) <= largest
    assert [r.doc_id for r in out] == [r.doc_id for r in mixing.mixed(docs).collect()]
    assert sum(r.doc_id == 7 and r.text is None for r in out) == 1
    assert mixing.curriculum(docs.limit(0)).collect() == [] == mixing.mixed(docs.limit(0)).collect()


def test_query_matches_sql(spark):
    frame = queries.mixing_plan(spark, SF)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = duck.execute(queries.MIXING_SQL).fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(expected)


def test_curriculum_counts_the_mix_itself(spark, documents, monkeypatch):
    """What a document gives is read from the mix: texts in training order, every pass at its own place."""
    docs = documents([(i, f" w{i} \t b\nc d{i}") for i in range(90)], "a")
    docs = docs.union(documents([(100 + i, "x y z w v") for i in range(10)] + [(150, " \n"), (None, None)], "b"))
    docs = docs.union(documents([(200, "x " * 400), (200, "x " * 400)], None))
    weights = [("a", 1, 2.0), ("b", 1, 0.0), (None, 1, 1.0)]
    weights = spark.createDataFrame(weights, "source string, weight int, start double")
    mix = mixing.pieces(docs, weights).collect()
    at = [r.position for r in mix]
    assert at == sorted(at)
    own = {s: [r for r in mix if r.source == s] for s in ("a", "b", None)}
    whole = {(r.doc_id): r.text for r in docs.collect()}
    cut = 0
    for source, integral in (("a", lambda t: 2 * t - t * t), ("b", lambda t: t * t)):
        words = sum(len((r.text or "").split()) for r in own[source])
        assert words == math.floor(own[source][0].target)
        for t in (0.3, 0.6, 0.9):
            ahead = sum(len((r.text or "").split()) for r in own[source] if r.position <= t)
            assert abs(ahead - integral(t) * words) <= 5
        for r in own[source]:
            assert r.text is None or whole[r.doc_id].startswith(r.text)
            cut += r.text is not None and r.text != whole[r.doc_id]
    assert cut <= 2 and {r.number for r in own["b"]} == {0, 1, 2}
    assert len({(r.source, r.bucket, r.place, r.number) for r in mix}) == len(mix)
    rows = mixing.curriculum(docs, weights).collect()
    taken = lambda found, n: sorted((n(r) for r in found if r.source == "b"), key=str)
    by_doc = {r.doc_id: sum(len((p.text or "").split()) for p in own["b"] if p.doc_id == r.doc_id) for r in own["b"]}
    assert taken(rows, lambda r: (r.doc_id, r.taken)) == sorted(by_doc.items(), key=str)
    whole_mix = mixing.pieces
    monkeypatch.setattr(mixing, "pieces", lambda *a: whole_mix(*a).where("number = 0"))
    assert all(r.taken <= r.size for r in mixing.curriculum(docs, weights).collect())


def test_unused_texts_are_not_shuffled(spark, documents, monkeypatch):
    """Behind the bucket where a source's target ends, rows travel without their texts, and the mix is the same."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    docs = documents([(i, f"w{i} b c d e") for i in range(400)] + [(None, "n m"), (None, None), (7, " \n")], "a")
    docs = docs.union(documents([(1000 + i, "x y z") for i in range(40)] + [(7, "\t"), (7, "\t")], None))
    weights = spark.createDataFrame([("a", 1, 2.0), (None, 12, 0.5)], "source string, weight int, start double")
    rows = mixing._placed(mixing._measured(docs, mixing.F.col("text")), "text", weights, 3).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    own = [r for r in rows if r.source == "a" and r.size]
    ends = {r.bucket: r.ahead >= math.floor(r.target) for r in own}
    assert 0 < sum(ends.values()) < len(ends)
    for r in own:
        assert (r.text is None) == ends[r.bucket]
    assert all(r.text == texts[r.doc_id] for r in rows if r.source is None and r.doc_id != 7)
    blank = lambda found: sorted((str(r.doc_id), r.text or "") for r in found if not r.size)
    assert blank(rows) == [("7", "\t"), ("7", "\t"), ("7", " \n"), ("None", "")]
    parts = [sorted(map(str, f(docs, weights).collect())) for f in (mixing.pieces, mixing.mixed)]
    monkeypatch.setattr(mixing, "CUT_SOURCES", 0)
    assert parts == [sorted(map(str, f(docs, weights).collect())) for f in (mixing.pieces, mixing.mixed)]
