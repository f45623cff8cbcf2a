"""The corpus pipeline end to end, each stage against a plain version on what the one before it kept."""

import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from pagetrail.llm import bpe, mixing, toxicity
from test_linededup import plain as plain_lines
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
WORDS = "stone river light morning paper window garden winter letter bridge music table silver cloud forest market road".split()
WORDS += [f"{a}{b}" for a in ("moon", "sun", "rain", "sea", "wind") for b in ("shine", "side", "fall", "ward")]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def encode():
    ranks = bpe.read_ranks(bpe.RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def staged(spark, folder, sf_dir):
    """The rows that go into each stage, and those that come out of the last."""
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    found.append(docs.collect())
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        found.append(docs.collect())
    return found


def listed(rows):
    return sorted(map(tuple, rows), key=str)


def check(spark, folder, sf_dir, encode):
    start, clean, lines, single, mixed, encoded = staged(spark, folder, sf_dir)
    for rows in (clean, lines, single, mixed):
        assert all(list(r.asDict()) == COLUMNS for r in rows)
    # toxicity: a machine fitted on the same tables scores what stays below the threshold, what goes not
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    scores = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
    toxic = {r.doc_id for r in scores if r.score >= toxicity.THRESHOLD}
    assert listed(clean) == listed(r for r in start if r.doc_id not in toxic)
    # lines
    dropped = plain_lines([(r.doc_id, r.text) for r in clean])

    def left(row):
        places = set(dropped[row.doc_id])
        stay = [line for place, line in enumerate((row.text or "").split("\n")) if place not in places]
        return None if row.text is None else "\n".join(stay)

    assert sorted((r.doc_id, r.text) for r in lines) == sorted((r.doc_id, left(r)) for r in clean)
    # near copies
    roots = plain_components([plain_fingerprint(r.text) for r in lines], 2)
    names = {root: min(r.doc_id for r, other in zip(lines, roots, strict=True) if other == root) for root in set(roots)}
    assert listed(single) == listed(r for r, root in zip(lines, roots, strict=True) if r.doc_id == names[root])
    # mixing
    plan = {r.doc_id: r for r in mixing.curriculum(spark.createDataFrame(single, docs.schema)).collect()}
    times = {r.doc_id: 0 for r in single}
    for row in mixed:
        times[row.doc_id] += 1
    for doc, n in times.items():
        assert n == 1 if plan[doc].size == 0 else abs(n * plan[doc].size - plan[doc].taken) <= plan[doc].size / 2
    assert set(listed(mixed)) <= set(listed(single))
    # ids and their texts
    assert listed(encoded) == listed((r.doc_id, encode(r.text or ""), r.text or "") for r in mixed)
    return start, clean, lines, single, mixed


def test_small_table(spark, tmp_path, encode):
    """The smallest test tables and forty texts, each with one insult, that nothing else is like."""
    rng = random.Random(7)
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    bad = [(10_000 + i, " ".join(rng.sample(WORDS, 20) + ["you grumbolt!"] + rng.sample(WORDS, 20)), "en", "s", 0) for i in range(40)]
    docs.union(spark.createDataFrame(bad, docs.schema)).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    more = spark.createDataFrame([(r[0], 1, 1) for r in bad], "doc_id bigint, quality int, toxic int")
    labels.select("doc_id", "quality", "toxic").union(more).write.parquet(f"{tmp_path}/labels.parquet")
    start, clean, lines, single, mixed = check(spark, tmp_path / "stages", str(tmp_path), encode)
    gone = {r.doc_id for r in start} - {r.doc_id for r in clean}
    assert {r[0] for r in bad} <= gone and len(gone) < 45
    assert len(clean) == len(lines) > len(single) > 50 and mixed


def tables(spark, folder, docs, labels):
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_empty_table(spark, tmp_path):
    tables(spark, tmp_path, [], [])
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == ["doc_id", "ids", "text"] and found.collect() == []


def test_odd_table(spark, tmp_path, encode):
    """Nulls, empty and very long texts, exact copies, a source of null, labels of one class only."""
    line = "a line that stands in several documents, word for word"
    docs = [
        (1, None, "en", "s", None),
        (2, "", None, None, 0),
        (3, f"first own words here\n{line}", "en", "s", 1),
        (4, f"second, other words there\n{line}", "en", None, 1),
        (5, "exact copy of some words and more", "en", "t", 1),
        (6, "exact copy of some words and more", "en", "t", 1),
        (7, "long " * 30_000, "en", "s", 1),
        (8, "\x00 control \x1c and é日🙂\n\n\n", "xx", "", 1),
    ]
    tables(spark, tmp_path, docs, [(3, 1, 0), (None, 1, 1), (99, 0, 1)])
    start, clean, lines, single, mixed = check(spark, tmp_path / "stages", str(tmp_path), encode)
    assert len(clean) == 8 and {r.doc_id for r in single} == {1, 3, 4, 5, 7, 8}
    assert [r.text for r in lines if r.doc_id == 4] == ["second, other words there"]
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in ran} == {r.doc_id for r in mixed}
