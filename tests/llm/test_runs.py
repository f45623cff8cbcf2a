import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from pagetrail.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(words, least=6, times=4):
    """All runs, by counting equal words at each distance."""
    found = {}
    for period in range(1, len(words) // times + 1):
        at = 0
        while at + period < len(words):
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at - start + period
            if length >= max(least, times * period):
                found.setdefault((start, length), period)
            at += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts_of(choose):
    texts = []
    for _ in range(choose.randint(0, 12)):
        kinds = choose.choice([1, 2, 3, 50])
        words = [choose.randrange(kinds) for _ in range(choose.randint(0, 120))]
        if words and choose.random() < 0.6:
            base = [choose.randrange(60) for _ in range(choose.randint(1, 40))]
            at = choose.randrange(len(words))
            words[at:at] = (base * 12)[: choose.randint(1, 300)]
        texts.append(words)
    return texts


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (5, 3), (40, 5)])
def test_runs_equal_brute_force(least, times, monkeypatch):
    choose = random.Random(least)
    for trial in range(40):
        monkeypatch.setattr(runs, "PLACES", choose.choice([3, 1 << 20]))
        texts = texts_of(choose)
        codes = np.array([w for t in texts for w in t], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        found = list(zip(*(x.tolist() for x in runs.find(codes, offsets, least, times)), strict=True))
        assert found == [(n, *run) for n, t in enumerate(texts) for run in plain(t, least, times)]


def test_extensions_equal_brute_force():
    choose = np.random.default_rng(1)
    words = np.concatenate([choose.integers(1, 3, 200), np.tile(choose.integers(1, 9, 37), 9), np.ones(150, dtype=np.int64), [99]])
    held = runs.Extensions(words)
    i = choose.integers(0, len(words), 4000)
    j = choose.integers(0, len(words), 4000)
    i, j = i[i != j], j[i != j]
    for a, b, n in zip(i, j, held.common(i, j), strict=True):
        assert (words[a : a + n] == words[b : b + n]).all()
        assert words[a + n] != words[b + n]


def test_cover_has_every_difference():
    assert {(a - b) % runs.PERIOD for a in runs.COVER for b in runs.COVER} == set(range(runs.PERIOD))


def test_operator(spark, documents):
    long = "x " + "a b c " * 9000
    rows = [(1, None), (2, ""), (3, " \t "), (4, "a a a a a"), (5, "b a a\x0ba a\n a a c"), (None, "q q q q q q"), (6, long), (6, long), (7, "ä\xa0ä " * 6)]
    found = sorted(map(tuple, runs.periodic_runs(documents(rows).withColumnRenamed("lang", "runs")).collect()), key=str)
    expected = []
    for i, text in rows:
        words = WORD.findall(text or "")
        some = plain(words)
        expected.append((i, some, some[0] if some else None, collapsed(words, some)))
    assert found == sorted(expected, key=str)
    assert runs.periodic_runs(documents([])).collect() == []
    with pytest.raises(ValueError, match="two periods"):
        runs.periodic_runs(documents([]), times=1)


def test_the_strongest_is_exact_and_ties_go_to_the_first(spark, documents):
    found = runs.periodic_runs(documents([(1, "a b " * 4 + "x " + "c d " * 4 + "e " * 6 + "f " * 7 + "g " * 7)])).collect()[0]
    assert tuple(found["strongest"]) == (23, 7, 1)


def test_query_equals_a_plain_version(spark, sf_dir="/root/testdata/sf0.001"):
    expected = set()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    for doc in docs:
        words = WORD.findall(doc.text or "")
        h = zlib.crc32(str(doc.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = plain(words)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
        milli = 1000 * best[1] // best[2] if found else None
        said = "".join("%d,%d,%d\n" % r for r in found)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (said, collapsed(words, found)))
        expected.add((doc.doc_id, len(found), *best, milli, *digests))
    rows = list(map(tuple, queries.repeated_runs(spark, sf_dir).collect()))
    assert set(rows) == expected
    assert len(rows) == len(docs)
    assert sum(r[1] > 0 for r in rows) > 10
