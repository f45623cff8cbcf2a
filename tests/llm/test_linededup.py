import random

import pytest

from pagetrail.llm import linededup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(above + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def edited(text, edits, rng):
    for _ in range(edits):
        at = rng.randrange(len(text) + 1)
        kind = rng.randrange(3)
        text = text[:at] + rng.choice(["", "x", "é", "b"]) * (kind != 0) + text[at + (kind != 1) :]
    return text


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_banded_distance(most):
    rng = random.Random(most)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 16)))
        b = edited(a, rng.randrange(0, 5), rng)
        assert linededup.within(a, b, most) == (distance(a, b) <= most), (a, b)


def plain(rows, most=2, least=20):
    """(doc_id, text) -> dropped places, by comparing all lines."""
    lines = {}
    for doc, text in rows:
        for place, line in enumerate((text or "").split("\n")):
            if len(line) >= least:
                lines.setdefault(line, []).append((doc, place))
    known = list(lines)
    root = list(range(len(known)))
    for i in range(len(known)):
        for j in range(i):
            if abs(len(known[i]) - len(known[j])) <= most and distance(known[i], known[j]) <= most:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    first, dropped = {}, {doc: [] for doc, _ in rows}
    for i, line in enumerate(known):
        first[root[i]] = min([first.get(root[i], (1e9, 0)), *lines[line]])
    for i, line in enumerate(known):
        for doc, place in lines[line]:
            if (doc, place) != first[root[i]]:
                dropped[doc].append(place)
    return {doc: sorted(places) for doc, places in dropped.items()}


@pytest.mark.parametrize("group_rows", [4, 1024])
def test_edges_against_all_pairs(spark, documents, group_rows):
    rng = random.Random(group_rows)
    bases = ["".join(rng.choice("abc é") for _ in range(rng.randrange(18, 40))) for _ in range(12)]
    texts = ["\n".join(edited(rng.choice(bases), rng.randrange(0, 4), rng) for _ in range(6)) for _ in range(25)]
    rows = list(enumerate(texts))
    edges = linededup.line_edges(documents(rows), group_rows=group_rows)
    from pagetrail.llm.components import connected_components

    groups = {}
    for node, root in connected_components(edges).collect():
        groups.setdefault(bytes(root), set()).add(bytes(node))
    import hashlib

    known = sorted({line for t in texts for line in t.split("\n") if len(line) >= 20})
    root = list(range(len(known)))
    for i in range(len(known)):
        for j in range(i):
            if distance(known[i], known[j]) <= 2:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    expected = {}
    for line, r in zip(known, root, strict=True):
        expected.setdefault(r, set()).add(hashlib.md5(line.encode()).digest())
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_documents(spark, documents):
    line, other = "This very line is repeated in many texts.", "A second line, quite unlike the first one."
    rows = [
        (1, f"{line}\n{other}\nEnd."),
        (2, f"{other[:-1]}\nEnd.\n\nNew and entirely different contents follow."),
        (3, f"{line}\n{line}"),
        (4, None),
        (5, ""),
        (6, "short\nshort"),
    ]
    docs = documents(rows).withColumnRenamed("lang", "line")
    found = {r.doc_id: (r.n_lines, r.dropped) for r in linededup.line_duplicates(docs).collect()}
    assert {d: v[1] for d, v in found.items()} == plain(rows)
    assert found[2] == (4, [0]) and found[3] == (2, [0, 1]) and found[4] == (1, [])
    clean = linededup.without_repeats(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    rest = "End.\n\nNew and entirely different contents follow."
    assert texts[1] == (rows[0][1], len(rows[0][1])) and texts[2] == (rest, len(rest))
    assert texts[3] == ("", 0) and texts[4] == (None, None) and texts[6][0] == "short\nshort"
    assert linededup.line_duplicates(docs.limit(0)).collect() == []


def test_repeated_rows_and_null_ids(spark, documents):
    line = "One line that stands in every one of these rows."
    docs = documents([(None, line), (7, line), (7, line), (8, line + "\n" + "x" * 50_000)])
    found = {(r.doc_id, r.n_lines): r.dropped for r in linededup.line_duplicates(docs).collect()}
    assert found == {(None, 1): [], (7, 1): [0], (8, 2): [0]}
    assert sorted(len(r.text) for r in linededup.without_repeats(docs).collect()) == [0, 0, len(line), 50_000]


def test_query_against_brute_force(spark):
    from pagetrail.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r.dropped for r in queries.dropped_lines(spark, sf).collect()}
    short = [(d, "\n".join(x if len(x) < 120 else "" for x in t.split("\n"))) for d, t in rows]
    exact = plain([(d, t) for d, t in rows], most=0)
    assert found.keys() == exact.keys()
    assert all(set(exact[d]) <= set(found[d]) for d in exact)
    near = plain(short)
    assert all(set(near[d]) <= set(found[d]) for d in near)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_distance_by_runs(most):
    rng = random.Random(most)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 16)))
        b = edited(a, rng.randrange(0, 5), rng)
        assert linededup._by_runs(a, b, most) == (distance(a, b) <= most), (a, b)


def test_keys_slab_by_slab(monkeypatch):
    import pyarrow as pa

    rng = random.Random(5)
    lines = ["".join(rng.choice("abc é") for _ in range(n)) for n in (150, 63, 64, 65, 129)]
    batch = pa.RecordBatch.from_arrays([pa.array(lines)], names=["text"])

    def keys():
        found = (b.to_pylist() for b in linededup._keys(iter([batch]), 2, 20))
        return {(r["key"], r["line"], r["indexed"]) for rows in found for r in rows}

    whole = keys()
    monkeypatch.setattr(linededup, "SLAB", 64)
    assert keys() == whole


def test_line_longer_than_a_slab(spark, documents):
    rng = random.Random(6)
    long = "".join(rng.choices("abcdefgh ", k=1000)) * (linededup.SLAB // 1000 + 1)
    near = "x" + long[: len(long) // 2] + "y" + long[len(long) // 2 + 1 :]
    other = long[::-1] + "z" * 100
    line = "An ordinary line that two documents have."
    docs = documents([(1, line), (2, long[: linededup.SLAB + 1]), (3, f"{line}\n{long}"), (4, near), (5, long), (6, other)])
    found = {r.doc_id: r.dropped for r in linededup.line_duplicates(docs).collect()}
    assert found == {1: [], 2: [], 3: [0], 4: [0], 5: [0], 6: []}
