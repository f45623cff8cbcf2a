import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pagetrail.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def features(form, reach):
    """The gap-weighted subsequences of three letters of an edged form, by enumeration."""
    form, found = f"^{form}^", {}
    for i in range(len(form)):
        for j in range(i + 1, len(form)):
            for k in range(j + 1, min(len(form), i + reach)):
                key = form[i] + form[j] + form[k]
                found[key] = found.get(key, 0.0) + toxicity.DECAY ** (k - i + 1)
    return found


def plain_share(form, mark):
    mine, whole = features(form, toxicity.REACH), features(mark, toxicity.MARK_REACH)
    return sum(min(amount, mine.get(key, 0.0)) for key, amount in whole.items()) / sum(whole.values())


def test_shares_against_enumeration():
    rng = random.Random(2)
    marks = ["idiot", "aaaa", "moron", "ab", "disgusting", "a~b"]
    forms = ["", "a", "idiot", "idxiot", "iidiot", "oronon", "idot", "aaab", "x" * 24, "a~bb"]
    forms += ["".join(rng.choices("idotmrn", k=rng.randrange(1, 12))) for _ in range(400)]
    found = toxicity.Landmarks(marks).shares(forms)
    for i, form in enumerate(forms):
        for j, mark in enumerate(marks):
            share = plain_share(form, mark)
            assert found[i, j] == pytest.approx(share, abs=1e-4) or (found[i, j] == 0 and share < toxicity.FLOOR), (form, mark)


def test_letters():
    assert [w.translate(toxicity.LETTERS) for w in ("I.d*i_o-t!", "ÉTÉ", "Straße", "日本", "1 2", "")] == ["idiot", "ete", "strasse", "~~", "", ""]


def test_sentences():
    long = " ".join(["w"] * 3 + ["word"] * 150)
    some = toxicity.sentences(pa.array(["One two. Three s c u m! four", None, "", " \n", long, "a b c, d"]))
    lines = [[some.forms[c] for c in part] for part in np.split(some.words, some.starts[1:])]
    assert lines[:3] == [["one", "two"], ["three", "scum", "c", "u", "m"], ["four"]]
    assert some.first.tolist() == [0, 3, 3, 3, 3, 6, 7]
    assert [len(x) for x in lines[3:]] == [64, 64, 25, 4] and lines[3][0] == "www" and lines[6][0] == "abcd"
    assert toxicity.sentences(pa.array(["", None], pa.string())).starts.tolist() == []


def test_long_words_are_windows():
    assert toxicity.windows("x" * 24) == ["x" * 24]
    assert "".join(w[:12] for w in toxicity.windows("ab" * 5000))[:9000] == ("ab" * 5000)[:9000]
    assert max(map(len, toxicity.windows("ab" * 5000))) == toxicity.WINDOW


def test_leverage_leaves_out_what_is_alike():
    forms = ["grumbolt", "grumbolt", "grumboltt", "snarvik", "plodwit"]
    assert toxicity.by_leverage(forms, np.array([9.0, 8, 7, 6, 5]), 3) == ["grumbolt", "snarvik", "plodwit"]
    assert toxicity.by_leverage([], np.zeros(0), 3) == []


def test_squared_hinge_is_at_its_least():
    rng = np.random.default_rng(1)
    points, signs, costs = rng.standard_normal((80, 3)), rng.choice([-1.0, 1.0], 80), rng.uniform(0.1, 2, 80)
    w, b = toxicity.squared_hinge(points, signs, costs)

    def loss(w, b):
        return w @ w / 2 + 5e-7 * b * b + costs @ np.maximum(0, 1 - signs * (points @ w + b)) ** 2

    for _ in range(200):
        assert loss(w + 0.01 * rng.standard_normal(3), b + 0.01 * rng.standard_normal()) >= loss(w, b)


def test_curve_never_falls():
    rng = np.random.default_rng(4)
    margins = rng.standard_normal(900)
    toxic = rng.random(900) < 1 / (1 + np.exp(-2 * margins))
    model = toxicity.calibrated(toxicity.Model((), np.zeros(0), -1.0), margins, toxic)
    scores = model.score(np.linspace(-9, 9, 500))
    assert (np.diff(scores) > 0).all() and 0 <= scores.min() and scores.max() <= 1
    assert abs(model.score(margins).mean() - toxic.mean()) < 0.05


@pytest.fixture(scope="module")
def corpus(spark, documents):
    rng = random.Random(3)
    syllables = ["ba", "no", "ti", "re", "lu", "ka", "mo", "se"]
    insults = ["grumbolt", "snarvik", "plodwit"]
    rows, labels = [], []
    for doc in range(900):
        text = ["".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(30)]
        toxic = doc % 4 == 0
        if toxic:
            word = rng.choice(insults)
            if doc % 3 == 0:
                word = word[:3] + rng.choice(".*-") + word[3:]
            text[rng.randrange(30)] = word
        rows.append((doc, " ".join(text)))
        if doc < 800:
            labels.append((doc, 1, int(toxic)))
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.scored(docs.withColumnRenamed("lang", "toxic"), model).collect()}
    assert len(scores) == 900 and all(0 <= s <= 1 for s in scores.values())
    assert np.mean([(scores[d] >= 0.7) == (d % 4 == 0) for d in range(800, 900)]) > 0.95
    odd = docs.withColumnRenamed("lang", "toxic").withColumnRenamed("source", "id")
    kept = toxicity.without_toxic(odd, odd, labels)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {d for d, s in scores.items() if s < 0.7}


def test_edge_cases(spark, corpus, documents):
    docs, labels = corpus
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (3, 1, None), (10**6, 0, 0)], labels.schema))
    model = toxicity.fit(docs, odd)
    more = documents([(1, None), (1, ""), (None, "grumbolt " * 20_000), (1, "grumbolt"), (2, "!!! ... 7")]).withColumnRenamed("lang", "score")
    found = [(r.doc_id, r.score >= 0.7) for r in toxicity.scored(more, model).collect()]
    assert sorted(found, key=str) == sorted([(1, False), (1, False), (None, True), (1, True), (2, False)], key=str)
    assert toxicity.scored(docs.limit(0), model).collect() == []
    nothing = toxicity.fit(docs, labels.limit(0))
    assert len({r.score for r in toxicity.scored(more, nothing).collect()}) == 1
    one_class = toxicity.fit(docs, labels.where("toxic = 0"))
    assert all(r.score < 0.1 for r in toxicity.scored(more, one_class).collect())


@pytest.fixture(scope="module")
def fitted(spark):
    """A machine fitted to the larger test tables, and their held-out texts."""
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    return toxicity.Scorer(toxicity.fit(docs, labels)), docs.join(labels, "doc_id").select("doc_id", "text", "toxic").collect()


def score(scorer, texts):
    return scorer.model.score(scorer.margins(pa.array(texts)))


def test_held_out_texts(fitted):
    scorer, rows = fitted
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    marked, toxic = score(scorer, [r.text for r in rows]) >= toxicity.THRESHOLD, np.array([r.toxic == 1 for r in rows])
    assert marked[toxic].mean() > 0.65 and marked[~toxic].mean() <= 0.01, (marked[toxic].sum(), toxic.sum(), marked[~toxic].sum())


INSULTS = "trash pathetic idiot disgusting worthless stupid clown loser scum moron".split()
SPELLED = {
    "plain": lambda w: w,
    "capitals": str.upper,
    "dots between": ".".join,
    "stars between": "*".join,
    "spaces between": " ".join,
    "a star put in": lambda w: f"{w[:2]}*{w[2:]}",
    "a letter put in": lambda w: f"{w[: len(w) // 2]}x{w[len(w) // 2 :]}",
    "a letter doubled": lambda w: w[:2] + w[1] + w[2:],
}


@pytest.mark.parametrize("name", SPELLED)
def test_insults_spelled_otherwise_are_found(fitted, name):
    texts = [f"The nding thre {SPELLED[name](word)} of erer the ingat." for word in INSULTS]
    assert (score(fitted[0], texts) >= toxicity.THRESHOLD).sum() >= 8


@pytest.mark.parametrize("text", ["a path through the woods", "nothing to lose", "it is worth it", "close the door", "more customs", "a sympathetic ear"])
def test_words_alike_are_left_alone(fitted, text):
    assert score(fitted[0], [text])[0] < toxicity.THRESHOLD


def test_query(spark):
    rows = {r.doc_id: r for r in queries.toxicity_scores(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id").collect()
    assert set(rows) == {d.doc_id for d in docs} and len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    assert sum(r.predicted for r in rows.values()) > 5
