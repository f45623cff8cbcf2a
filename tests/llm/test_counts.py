import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pagetrail.llm import counts, pieces, queries

PARTS = ["a", "the", " ", "  ", "   ", "\n", " \n", "\t", "é", "ß", "日本", "12", "'s", "'ll", "!!", "<|endoftext|>", "<|endof",
         "\xa0", " ", "\x1c", "x" * 30, "…", "👍🏽", "don't", "́", "\r\n", "\x85", "worldwide", "0"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(counts.TOKENIZER)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts_equal_the_library(library):
    choose = random.Random(2)
    texts = ["".join(choose.choices(PARTS, k=choose.randint(0, 14))) for _ in range(20_000)]
    assert counts.Counter(counts.TOKENIZER).counts(pa.array(texts)).tolist() == library(texts)


def test_long_pieces_equal_the_library(library):
    choose = random.Random(3)
    texts = ["a" * 50_000, "".join(choose.choices("abcdeté", k=40_000)), "!" * 3001, " " * 4000 + "x", "x\n" * 3000, "the" * 9000]
    assert counts.Counter(counts.TOKENIZER).counts(pa.array(texts)).tolist() == library(texts)


def test_query_equals_the_library(spark, library, sf_dir="/root/testdata/sf0.001"):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.token_counts(spark, sf_dir).collect()
    plain = dict(zip(docs, library(list(docs.values())), strict=True))
    assert {tuple(r) for r in found} == {(i, len(docs[i].encode()), n, n > 1024) for i, n in plain.items()}
    assert len(found) == len(docs)


def test_rows_come_out_as_they_went_in(spark, documents):
    rows = [(1, None), (2, ""), (None, "one two"), (3, "one two"), (3, "one two"), (4, "<|endoftext|>")]
    found = counts.token_counts(documents(rows).withColumnRenamed("lang", "n_tokens"), limit=1)
    assert sorted((r for r in map(tuple, found.collect())), key=str) == sorted(
        [(1, 0, 0, False), (2, 0, 0, False), (None, 7, 2, True), (3, 7, 2, True), (3, 7, 2, True), (4, 13, 1, False)], key=str
    )
    assert counts.token_counts(documents([])).collect() == []
    named = spark.createDataFrame([("x", "hello")], "doc_id string, text string")
    assert counts.token_counts(named).collect()[0][:3] == ("x", 5, 1)


def test_other_models_are_an_error():
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        counts.Counter(public_tokenizers.path("word_bpe_49k.json"))


def test_held_is_bounded():
    asked = []
    held = pieces.Held(lambda k: asked.append(k) or len(k), limit=100_000)
    for turn in range(3):
        for n in range(5000):
            assert held[f"key {n}"] == len(f"key {n}")
            held["often"]
            assert len(held) + len(held.old) < 1000
    assert asked.count("often") == 1
    assert len(asked) == 15_001


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "SLICE_BYTES", 100)
    texts = ["x" * 60, None, "y" * 500, "", "z"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(15)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(pieces.slices(batch, 1))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts
    assert len(parts) > 3


def test_one_operator_at_a_time(monkeypatch):
    monkeypatch.setattr(pieces, "_holder", ["", lambda: None])
    dropped = []
    for name in ("a", "a", "b", "a"):
        pieces.claim(name, lambda name=name: dropped.append(name))
    assert dropped == ["a", "b"]


def test_memory_goes_back_to_the_system(monkeypatch):
    """Behind each slice, and when another operator takes the worker: else what Arrow keeps adds up with the stores."""
    calls = []
    pool = type("Pool", (), {"release_unused": lambda self: calls.append(1)})()
    monkeypatch.setattr(pieces.pa, "default_memory_pool", lambda: pool)
    monkeypatch.setattr(pieces, "_holder", ["", lambda: None])
    monkeypatch.setattr(pieces, "SLICE_BYTES", 10)
    batch = pieces.pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["a" * 12, "b" * 12, "c" * 12]})
    assert sum(part.num_rows for part in pieces.slices(batch, 1)) == 3 and len(calls) == 3
    pieces.claim("one", lambda: None)
    pieces.claim("one", lambda: None)
    assert len(calls) == 4
