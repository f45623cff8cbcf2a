import random
import sys

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from pagetrail.llm import bpe, pieces


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(bpe.RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder()


def test_every_character(reference, encoder):
    text = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(text), 5000):
        joined = " ".join(f"a{c}1{c} {c}" for c in text[start : start + 5000])
        assert encoder.encode(joined).tolist() == reference.encode_ordinary(joined)


@pytest.mark.parametrize("alphabet", ["ab", "a \n", "aé'st ", "0 1.", "the in", "　  \x1c\x85a", "日本語 😀é"])
def test_random_texts(reference, encoder, alphabet):
    rng = random.Random(alphabet)
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60)))
        assert encoder.encode(text).tolist() == reference.encode_ordinary(text), repr(text)


def test_long_pieces(reference, encoder):
    for text in ("a" * 30_000, " " * 5000 + "x", "ab" * 9000, "<|endoftext|>" * 3, "é" * 4000, "\n \n" * 700):
        assert encoder.encode(text).tolist() == reference.encode_ordinary(text)


def test_documents(reference, encoder, spark):
    for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect():
        assert encoder.encode(row.text).tolist() == reference.encode_ordinary(row.text)


def test_states_can_be_dropped(monkeypatch, reference):
    monkeypatch.setattr(bpe, "HELD_PAIRS", 20)
    monkeypatch.setattr(bpe, "HELD_STATES", 20)
    encoder = bpe.Encoder()
    text = "Strange words: supercalifragilistic, onomatopoeia; antidisestablishmentarianism!"
    assert encoder.encode(text).tolist() == reference.encode_ordinary(text)


def test_neighbours_equal_plain_merging(encoder):
    transducer = encoder.transducer
    rng = random.Random(6)
    common = list(range(3000))
    for _ in range(20_000):
        a, b = rng.choice(common), rng.choice(common)
        data = [transducer.tokens[a], transducer.tokens[b]]
        alone = all(transducer._merged(d)[0] == [d] for d in data)
        assert transducer._follows(a, b) == (alone and transducer._merged(b"".join(data))[0] == data), data


def test_worker_memory_is_bounded(encoder):
    rng = random.Random(8)
    for _ in range(40):
        encoder.lists(pa.array([" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(2000))]))
    transducer, held = encoder.transducer, encoder.pieces
    assert len(transducer.states) < bpe.HELD_STATES + 100 and len(transducer.fits) < bpe.HELD_PAIRS + 1000
    entries = [*held.items(), *held.old.items()]
    assert sum(sys.getsizeof(k) + sys.getsizeof(v) + pieces.ENTRY for k, v in entries) <= bpe.HELD_PIECES


def test_streaming_decoder(encoder):
    tokens = encoder.transducer.tokens
    decoder = bpe.Decoder(tokens)
    text = "é日本語😀 plain ́"
    ids = [bpe.read_ranks(bpe.RANKS)[bytes((b,))] for b in text.encode()]
    pieces = [decoder.feed([i]) for i in ids]
    assert "".join(pieces) + decoder.finish() == text and pieces[0] == ""
    rng = random.Random(1)
    single = {b[0]: i for i, b in tokens.items() if len(b) == 1}
    for _ in range(3000):
        data = bytes(rng.choice(b"a\x80\xbf\xc2\xe0\xed\xf0\xf4\x90\xff") for _ in range(rng.randrange(8)))
        assert decoder.feed([single[b] for b in data]) + decoder.finish() == data.decode(errors="replace"), data


def test_operator(spark, documents, reference):
    rows = [(1, None), (1, ""), (None, "Zwei  Wörter\n"), (2, "x" * 100_000)]
    docs = documents(rows).withColumnRenamed("lang", "ids")
    ids = bpe.encoded(docs)
    assert [(r.doc_id, r.ids) for r in ids.collect()] == [(d, reference.encode_ordinary(t or "")) for d, t in rows]
    assert [r.text for r in bpe.decoded(ids).collect()] == [t or "" for _, t in rows]
    assert bpe.encoded(docs.limit(0)).collect() == []


def test_query(spark, reference):
    import hashlib

    from pagetrail.llm import queries

    sf = "/root/testdata/sf0.001"
    sha = lambda data: hashlib.sha256(data).hexdigest()
    expected = set()
    for doc, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = reference.encode_ordinary(text)
        expected.add((doc, len(ids), sha(" ".join(map(str, ids)).encode()), sha(text.encode())))
    assert {tuple(r) for r in queries.bpe_round_trip(spark, sf).collect()} == expected


def test_pipeline_decodes_its_own_rows(spark, documents):
    import corpus_pipeline

    texts = ["One text, é日 and 🙂.", "", "One text, é日 and 🙂.", "a\n\n  b"]
    rows = corpus_pipeline.encode(spark, documents(list(enumerate(texts))), "").collect()
    assert {r.doc_id: r.text for r in rows} == dict(enumerate(texts))
    assert all(r.ids for r in rows if r.text)


def test_states_take_few_bytes(encoder):
    """A state's hypotheses are numbers: 180,000 states take what 120,000 took as tuples of bytes."""
    import tracemalloc

    transducer = bpe.Transducer(encoder.transducer.ranks)
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoinsrhld'é", k=12)).encode() for _ in range(4000)]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        for word in words:
            transducer.encode(word)
        transducer.fits, transducer.edges = {}, {}
        taken = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert len(transducer.states) > 5000
    assert taken / len(transducer.states) < 440


def test_decoder_takes_whole_blocks(encoder, monkeypatch):
    """One unfinished character slows down the block of ids that it stands in, not those around it."""
    decoder = bpe.Decoder(encoder.transducer.tokens)
    ids = encoder.encode(("plain words " * 400 + "\U0001f9ff") * 3).tolist()
    decoder.feed(ids), decoder.finish()
    slow = []
    taken = decoder._taken
    monkeypatch.setattr(decoder, "_taken", lambda some: slow.append(len(some)) or taken(some))
    assert decoder.feed(ids) + decoder.finish() == ("plain words " * 400 + "\U0001f9ff") * 3
    assert 0 < sum(slow) <= 6 * bpe.FED_IDS < len(ids)
