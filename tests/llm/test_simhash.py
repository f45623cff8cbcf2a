import random

import numpy as np
import pytest
import xxhash

from pagetrail.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, most):
    root = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= most:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def signed(code):
    return code - (1 << 64) if code >> 63 else code


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "É a b c\x1cd E f g", "x " * 70_000])
def test_fingerprint_matches_definition(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_gray_rank_orders_neighbours_one_bit_apart():
    codes = np.arange(1 << 10, dtype=np.uint64)
    ranked = codes[np.argsort(simhash.gray_rank(codes))]
    assert {int(a ^ b).bit_count() for a, b in zip(ranked, ranked[1:], strict=False)} == {1}


@pytest.mark.parametrize("group_rows", [3, 2048])
def test_edges_connect_what_links_connect(spark, group_rows):
    rng = random.Random(5)
    codes = {0, (1 << 64) - 1}
    for _ in range(25):  # chains of near fingerprints, and one crowd around a single one
        code = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 8)):
            codes.add(code)
            for _ in range(rng.randrange(1, 4)):
                code ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    codes |= {centre ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(60)}
    codes = sorted(codes)
    frame = spark.createDataFrame([(signed(c),) for c in codes], "fp bigint")
    found = simhash.connected_components(simhash.edges(frame, 2, group_rows)).collect()
    roots = {r.node: r.root for r in found}
    groups = [roots.get(signed(c), signed(c)) for c in codes]
    expected = plain_components(codes, 2)
    assert len(set(groups)) == len(set(expected)) == len(set(zip(groups, expected, strict=True)))


def test_edge_cases(spark, documents):
    rows = [(5, None), (3, ""), (3, ""), (9, "Some words that stand alone here"), (None, "some WORDS that stand alone here")]
    docs = documents(rows).withColumnRenamed("lang", "fp")
    found = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    code = f"{plain_fingerprint(rows[3][1]):016x}"
    zero = "0" * 16
    assert found == sorted([(5, zero, 3), (3, zero, 3), (3, zero, 3), (9, code, 9), (None, code, 9)], key=str)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 3, 9]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    from pagetrail.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    codes = [plain_fingerprint(d.text) for d in docs]
    roots = plain_components(codes, 2)
    expected = {(d.doc_id, f"{c:016x}", docs[r].doc_id) for d, c, r in zip(docs, codes, roots, strict=True)}
    assert {tuple(r) for r in queries.simhash_groups(spark, sf).collect()} == expected
