import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pagetrail.llm import queries, records


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(records.TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def expected(rows, reference):
    start, out = 0, []
    for doc, text in rows:
        ids = [*reference(text), 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_encoding_by_chunks(reference):
    library = records.Library(records.TOKENIZER)
    assert not library.wide
    rng = random.Random(9)
    texts = [None]
    for alphabet in ("ab 's", "a \n\t", "  　x", "é日 1.", "<|endoftext|> "):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(300)]
    plain = Tokenizer.from_file(records.TOKENIZER)
    assert library.lists(pa.array(texts)).to_pylist() == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_damage_is_found():
    data = records.frame(b"one\n") + b"\n" + records.frame(b"") + b"\n"
    assert [p for _, p in records.frames(data)] == [b"one\n", b""]
    for at in range(len(data)):
        broken = data[:at] + bytes((data[at] ^ 4,)) + data[at + 1 :]
        with pytest.raises(ValueError):
            list(records.frames(broken))
    for at in range(1, len(data)):
        if at != len(records.frame(b"one\n")) + 1:
            with pytest.raises(ValueError):
                list(records.frames(data[:at]))


def test_round_trip(spark, documents, reference, tmp_path):
    rows = [(None, "no id"), (-3, None), (1, "A text\nof two lines \x00"), (1, "A text\nof two lines \x00"), (4, ""), (9, "x y " * 50_000)]
    docs = documents(rows[::-1]).withColumnRenamed("lang", "record")
    records.write(docs, f"{tmp_path}/out")
    found = records.index(spark, f"{tmp_path}/out")
    listed = found.orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in listed] == expected(rows, reference)
    random.Random(2).shuffle(listed)
    for row, (doc, ids) in zip(listed, records.documents_at((r.file, r.offset) for r in listed), strict=True):
        assert doc == row.doc_id and ids[-1] == 2 and len(ids) == row.n_tokens
    records.write(docs.limit(0), f"{tmp_path}/empty")
    assert records.index(spark, f"{tmp_path}/empty").collect() == []


def test_files_are_cut_by_bytes(spark, documents, reference, tmp_path):
    rows = [(i, f"text {i} " * (i % 7 * 40)) for i in range(120)]
    folder = f"{tmp_path}/out"
    records.write(documents(rows).repartition(5), folder, file_bytes=3000)
    listed = records.index(spark, folder).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in listed] == expected(rows, reference)
    sizes = {f: p.stat().st_size for p in tmp_path.rglob("part-*") for f in [p.parent.name]}
    assert len(sizes) > 5 and max(sizes.values()) < 3000 + 1000
    with pytest.raises(TypeError, match="integer"):
        records.write(spark.createDataFrame([("a", "b")], "doc_id string, text string"), f"{tmp_path}/odd")


def test_query(spark, reference):
    sf = "/root/testdata/sf0.001"
    rows = sorted(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    assert sorted(map(tuple, queries.token_records(spark, sf).collect())) == expected(rows, reference)


def test_added_tokens_as_the_untouched_library_finds_them(spark, documents, tmp_path):
    library = Tokenizer.from_file(records.TOKENIZER)
    encode = lambda text: records.Library(records.TOKENIZER).lists(pa.array([text]))[0].as_py()
    rng = random.Random(4)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " a", "b ", " ", "\n", "é's 12"]
    texts = ["a <|endoftext|> b"] + ["".join(rng.choices(parts, k=rng.randrange(9))) for _ in range(500)]
    found = records.Library(records.TOKENIZER).lists(pa.array(texts)).to_pylist()
    assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert encode(texts[0]) == [64, 220, 50256, 275]
    rows = list(enumerate([*texts[:3], "behind them"]))
    records.write(documents(rows), f"{tmp_path}/out")
    listed = records.index(spark, f"{tmp_path}/out").orderBy("start").collect()
    plain = lambda text: library.encode(text, add_special_tokens=False).ids
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in listed] == expected(rows, plain)


def test_new_chunks_are_encoded_together(monkeypatch):
    """A slice's chunks go to the library in few calls, each chunk once, and are held in few bytes."""
    library = records.Library(records.TOKENIZER)
    plain = Tokenizer.from_file(records.TOKENIZER)
    calls, encode = [], library._ids
    monkeypatch.setattr(library, "_ids", lambda text: calls.append(len(text)) or encode(text))
    monkeypatch.setattr(records, "JOINED_BYTES", 2000)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcé日'1.\n\x85") for _ in range(rng.randrange(1, 9)))
    texts = ["first " + " ".join(word() for _ in range(60)) for _ in range(50)] + ["a  b \tc", "x<|endoftext|> y", "", None]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert library.lists(pa.array(texts)).to_pylist() == want
    distinct = len(library.chunks.names)
    assert sum(n > 500 for n in calls) < 40 and distinct > 1500
    calls.clear()
    assert library.lists(pa.array(texts[::-1])).to_pylist() == want[::-1] and calls == [len("x<|endoftext|> y")]
    library.chunks.limit = 1000
    for text, ids in zip(texts, want, strict=True):
        assert library.lists(pa.array([text], pa.string())).to_pylist() == [ids]
        assert len(library.chunks.names) <= 70
    library.sizes[:] = 0  # another model's tokens, whose sizes say nothing
    library.chunks.names, library.chunks.ids, library.chunks.ends = pa.array([], pa.string()), np.empty(0, "<i4"), np.zeros(1, "<i8")
    assert library.lists(pa.array(texts)).to_pylist() == want
