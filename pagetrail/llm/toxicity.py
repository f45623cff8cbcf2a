"""Toxicity by a support vector machine over a gap-weighted subsequence string kernel of sentences.

A word is seen as its letters alone, without case, accents and whatever stands between them; single letters in a row are
one word. Its features are its subsequences of three letters, the edges of the word counting as letters, each discounted
by DECAY for every letter that it spans, up to REACH. So letters put in or doubled weaken a feature without ending it,
while letters left out end all features that hold them.

Nyström landmarks are the words of labelled texts with the most leverage: those that mark toxic ones and are least like
the landmarks chosen before. A word's kernel with a landmark is an exponential of how much of the landmark's features it
has; a sentence's is the sum over its words. The machine is a squared-hinge one, fitted to labelled sentences, and again
to the clean ones and those toxic ones that it tells from them, as most sentences of a toxic text are harmless. A text's
margin is that of its worst sentence, and a logistic curve fitted to labelled texts makes a probability of it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.llm.common import keep
from pagetrail.llm.pieces import Held, claim, slices, split_words

#: Discount of a letter that a feature spans, and how many it spans at most, in a word and in a landmark.
DECAY, REACH, MARK_REACH = 0.98, 7, 5
#: Shares of a landmark's features below this are counted as none. Width of the exponential.
FLOOR = 0.5
WIDTH = 0.15
#: Landmarks at most.
LANDMARKS = 96
#: Labelled texts of each class that are used, about, and sentences of each class with something in common with a landmark
#: that the machine is fitted on, about; hashes choose them. All other sentences are one point, as often as they are there.
TRAIN_DOCS, TRAIN_SENTENCES = 4000, 10_000
#: Candidates for landmarks, at most, and the evidence (twice the log-likelihood ratio) that they need.
CANDIDATES, EVIDENCE = 600, 22.0
#: Kernel value from which a word has something in common with a landmark.
COMMON = 0.05
#: Letters of a word looked at together; longer words are looked at in windows that overlap by half.
WINDOW = 24
#: Words of a sentence at most; a longer one is several.
SENTENCE = 64
#: Single letters in a row that are read as one word.
SPELLED = 3
#: Regularisation, and Newton steps of the machine at most.
COST, STEPS = 0.1, 40
#: Share of the clean sentences that score lower than what counts as toxic in the second fit.
TOLD = 0.995
#: Blocks of the curve and texts of a block; what the margin itself adds to the score.
CURVE, LEAST, TILT = 60, 20, 0.01
#: A text with this score or more is toxic.
THRESHOLD = 0.7
#: Characters behind which a sentence ends.
STOPS = ".!?…"
#: The edge of a word, and any letter beyond a to z.
EDGE, OTHER = "^", "~"


# ---- words as letters ------------------------------------------------------------


class _Letters(dict):
    """A table for str.translate(): each character as the plain letters it is made of, nothing if it is no letter."""

    def __missing__(self, code: int) -> str:
        parts = unicodedata.normalize("NFD", chr(code).casefold())
        found = self[code] = "".join(c if "a" <= c <= "z" else OTHER for c in parts if c.isalpha())
        return found


LETTERS = _Letters()
CODES = np.zeros(256, dtype=np.int64)
CODES[[*range(ord("a"), ord("z") + 1), ord(OTHER), ord(EDGE)]] = range(1, 29)
SIZE = 29


def windows(form: str) -> list[str]:
    if len(form) <= WINDOW:
        return [form]
    return [form[start : start + WINDOW] for start in range(0, len(form) - WINDOW // 2, WINDOW // 2)]


def _coded(forms: list[str]) -> np.ndarray:
    """One row of codes for each form, its edges included, zero behind its end."""
    width = WINDOW + 2
    edged = np.array([f"{EDGE}{form}{EDGE}" for form in forms], dtype=f"S{width}")
    return CODES[edged.view(np.uint8).reshape(len(forms), width)]


def _places(size: int, reach: int) -> Iterator[tuple[int, int, int]]:
    for first in range(size):
        for last in range(first + 2, min(size, first + reach)):
            for middle in range(first + 1, last):
                yield first, middle, last


def _features(codes: np.ndarray, first: int, middle: int, last: int) -> np.ndarray:
    return (codes[:, first] * SIZE + codes[:, middle]) * SIZE + codes[:, last]


class Landmarks:
    """Words that others are compared with."""

    def __init__(self, forms: list[str]) -> None:
        self.forms = forms
        codes = _coded(forms)
        found: list[dict[int, float]] = [{} for _ in forms]
        for mark, form in enumerate(forms):
            for places in _places(len(form) + 2, MARK_REACH):
                feature = int(_features(codes[mark : mark + 1], *places)[0])
                found[mark][feature] = found[mark].get(feature, 0.0) + DECAY ** (places[-1] - places[0] + 1)
        most = max(map(len, found), default=0)
        #: [landmark, feature]: the feature's column in `amounts`; one more column holds what is no feature of it
        self.column = np.full((len(forms), SIZE**3), most, dtype=np.int16)
        self.amounts = np.zeros((len(forms), most + 1), dtype=np.float32)
        self.parts = np.zeros((SIZE**3, len(forms)), dtype=np.float32)
        for mark, features in enumerate(found):
            for column, (feature, amount) in enumerate(features.items()):
                self.column[mark, feature], self.amounts[mark, column] = column, amount
                self.parts[feature, mark] = amount / sum(features.values())
        self.used = self.parts.any(axis=1)

    def shares(self, forms: list[str]) -> np.ndarray:
        """[form, landmark]: the share of the landmark's features that a form of at most WINDOW letters has, as far as it
        has them (the intersection of both); 0 if it is below FLOOR for sure."""
        shares = np.zeros((len(forms), len(self.forms)), dtype=np.float32)
        if not forms:
            return shares
        codes, sizes = _coded(forms), np.fromiter(map(len, forms), dtype=np.int64, count=len(forms)) + 2
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            here, bound = codes[rows], np.zeros((len(rows), len(self.forms)), dtype=np.float32)
            for places in _places(int(size), REACH):
                feature = _features(here, *places)
                shared = np.flatnonzero(self.used[feature])  # the others have nothing in common with any landmark
                if len(shared):
                    bound[shared] += self.parts[feature[shared]]
            row, mark = np.nonzero(bound >= FLOOR)
            if len(row):
                shares[rows[row], mark] = self._common(here[row], int(size), mark)
        return shares

    def _common(self, codes: np.ndarray, size: int, mark: np.ndarray) -> np.ndarray:
        amounts, pair = np.zeros((len(mark), self.amounts.shape[1]), dtype=np.float32), np.arange(len(mark))
        for places in _places(size, REACH):
            amounts[pair, self.column[mark, _features(codes, *places)]] += np.float32(DECAY ** (places[-1] - places[0] + 1))
        whole = self.amounts[mark]
        return np.minimum(amounts, whole).sum(axis=1) / whole.sum(axis=1)

    def kernel(self, forms: list[str]) -> np.ndarray:
        """From 0 for nothing in common to 1 for everything that a landmark has."""
        return np.expm1(self.shares(forms) / WIDTH) / np.float32(np.expm1(1 / WIDTH))


# ---- sentences of texts ------------------------------------------------------------


@dataclass
class Sentences:
    """The sentences of some texts: `words` are places in `forms`, `starts` where sentences start among the words,
    `first` the first sentence of each text; a text without words has none."""

    forms: list[str]
    words: np.ndarray
    starts: np.ndarray
    first: np.ndarray


def sentences(texts: pa.Array) -> Sentences:
    words, offsets = split_words(texts)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    tokens = coded.dictionary.to_pylist()
    forms = [token.translate(LETTERS) for token in tokens]
    sizes = np.fromiter(map(len, forms), dtype=np.int64, count=len(forms))
    stop = np.fromiter((token[-1] in STOPS for token in tokens), dtype=bool, count=len(tokens))
    count = len(codes)
    begin = np.zeros(count + 1, dtype=bool)
    begin[offsets] = True
    begin[1:] |= stop[codes] if count else False
    if count:
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        begin[:-1] |= (np.arange(count) - offsets[text]) % SENTENCE == 0
    extra = _spelled(codes, sizes, offsets, forms)
    # a spelled word stands where its first letter does
    codes = codes.copy()
    for place, form in extra:
        codes[place] = len(forms)
        forms.append(form)
    starts = np.flatnonzero(begin[:-1])
    return Sentences(forms, codes, starts, np.searchsorted(starts, offsets))


def _spelled(codes: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, forms: list[str]) -> list[tuple[int, str]]:
    """(place, letters) of the runs of single letters; words without any letter do not end them."""
    places = np.flatnonzero(sizes[codes] > 0) if len(codes) else np.zeros(0, dtype=np.int64)
    single = sizes[codes[places]] == 1
    text = np.searchsorted(offsets, places, side="right")
    new = np.ones(len(places), dtype=bool)
    new[1:] = (single[1:] != single[:-1]) | (text[1:] != text[:-1])
    edges = np.concatenate([np.flatnonzero(new), [len(places)]])
    long = np.flatnonzero((np.diff(edges) >= SPELLED) & single[edges[:-1][: len(edges) - 1]]) if len(places) else []
    found = []
    for run in long:
        run_places = places[edges[run] : edges[run + 1]]
        found.append((int(run_places[0]), "".join(forms[c] for c in codes[run_places].tolist())))
    return found


# ---- the machine -------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """A machine and the curve from margins to shares of toxic texts; without landmarks every text gets the same score."""

    marks: tuple[str, ...]
    gains: np.ndarray
    bias: float
    knots: tuple[float, ...] = (0.0,)
    shares: tuple[float, ...] = (0.5,)

    def score(self, margins: np.ndarray) -> np.ndarray:
        # a little of the margin itself keeps different margins apart where the curve is level
        level = 1 / (1 + np.exp(-np.clip(margins, -500, 500)))
        return (1 - TILT) * np.interp(margins, self.knots, self.shares) + TILT * level


class Scorer:
    """Margins of texts, with what each word adds held while it is in use."""

    def __init__(self, model: Model) -> None:
        claim("toxicity", lambda: None)
        self.model = model
        self.landmarks = Landmarks(list(model.marks)) if model.marks else None
        self.held = Held(float)

    def gains(self, forms: list[str]) -> list[float]:
        """What each form adds to its sentence: of a long one, its worst window."""
        parts = [windows(form) for form in forms]
        flat = [part for some in parts for part in some]
        found = np.concatenate(
            [self.landmarks.kernel(flat[start : start + 50_000]) @ self.model.gains for start in range(0, len(flat), 50_000)]
        )
        ends = np.cumsum([0, *map(len, parts)])
        return np.maximum.reduceat(found, ends[:-1]).tolist()

    def margins(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.model.bias)
        if self.landmarks is None:
            return out
        some = sentences(texts)
        if not len(some.words):
            return out
        gain = np.array(self.held.many(some.forms, self.gains))
        sums = np.add.reduceat(gain[some.words], some.starts)
        full = some.first[1:] > some.first[:-1]
        out[full] += np.maximum.reduceat(sums, some.first[:-1][full])
        return out


def by_leverage(forms: list[str], weights: np.ndarray, count: int) -> list[str]:
    """The forms chosen one by one for the greatest weight times what is left of them beside those chosen before: a
    pivoted Cholesky factorisation of their kernel."""
    if not forms:
        return []
    kernel = Landmarks(forms).kernel(forms).astype(float)
    kernel = (kernel + kernel.T) / 2
    left, factor, chosen = np.ones(len(forms)), np.zeros((len(forms), 0)), []
    for _ in range(min(count, len(forms))):
        best = int(np.argmax(weights * left))
        if weights[best] * left[best] <= 1e-6:
            break
        column = (kernel[:, best] - factor @ factor[best]) / np.sqrt(left[best])
        factor = np.column_stack([factor, column])
        left = np.clip(left - column**2, 0, 1)
        left[best] = 0
        chosen.append(forms[best])
    return chosen


def squared_hinge(points: np.ndarray, signs: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, bias) of least |weights|^2 / 2 + costs * max(0, 1 - sign * margin)^2, by Newton steps."""
    full = np.column_stack([points, np.ones(len(points))])
    ridge = np.eye(full.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(full.shape[1])

    def loss(w: np.ndarray) -> float:
        return float(w @ ridge @ w / 2 + costs @ np.maximum(0, 1 - signs * (full @ w)) ** 2)

    now = loss(w)
    for _ in range(STEPS):
        short = 1 - signs * (full @ w)
        inside = short > 0
        some = full[inside]
        slope = ridge @ w - 2 * some.T @ (costs[inside] * signs[inside] * short[inside])
        step = np.linalg.solve(ridge + 2 * some.T @ (some * costs[inside, None]), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w, before = w - size * step, now
        now = loss(w)
        if before - now <= 1e-9 * (1 + abs(now)):
            break
    return w[:-1], float(w[-1])


def landmarks_of(told: dict[str, float]) -> tuple[str, ...]:
    """Landmarks from words by how strongly they mark toxic texts."""
    return tuple(by_leverage(list(told), np.array(list(told.values())), LANDMARKS))


def _points(some: Sentences, landmarks: Landmarks) -> tuple[np.ndarray, np.ndarray]:
    """(sentences, points) of the sentences with something in common with a landmark: the sums of their words' kernels."""
    kernel = landmarks.kernel([form[:WINDOW] for form in some.forms])
    active = (kernel > COMMON).any(axis=1)
    at = np.flatnonzero(active[some.words])
    which, row = np.unique(np.searchsorted(some.starts, at, side="right") - 1, return_inverse=True)
    points = np.zeros((len(which), kernel.shape[1]))
    np.add.at(points, row, kernel[some.words[at]])
    return which, points


def train(marks: tuple[str, ...], points: np.ndarray, toxic: np.ndarray, counts: np.ndarray) -> Model:
    """A machine from points of sentences, each as often as `counts` says."""
    between = Landmarks(list(marks)).kernel(list(marks)).astype(float)
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    white = vectors / np.sqrt(np.maximum(values, 1e-2)) @ vectors.T
    full, signs = points @ white, np.where(toxic, 1.0, -1.0)

    costs = COST * counts
    w, bias = squared_hinge(full, signs, costs)
    margins = full @ w + bias
    order = np.argsort(margins[~toxic])
    below = np.cumsum(counts[~toxic][order])
    bound = margins[~toxic][order][np.searchsorted(below, TOLD * below[-1])]
    stays = ~toxic | (margins > bound)
    if (stays & toxic).any():
        w, bias = squared_hinge(full[stays], signs[stays], costs[stays])
    return Model(marks, white @ w, bias)


def calibrated(model: Model, margins: np.ndarray, toxic: np.ndarray) -> Model:
    """The model with the curve that fits the texts' margins best among those that never fall: shares of toxic texts in
    blocks of neighbouring margins, merged while a block has a smaller share than one below it."""
    order = np.argsort(margins, kind="stable")
    blocks: list[list[float]] = []  # texts, toxic ones, sum of margins
    for chunk in np.array_split(order, max(1, min(CURVE, len(order) // LEAST))):
        blocks.append([len(chunk), float(toxic[chunk].sum()), float(margins[chunk].sum())])
        while len(blocks) > 1 and _share(blocks[-2]) >= _share(blocks[-1]):
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    knots = [total / max(size, 1) for size, _, total in blocks]
    return replace(model, knots=tuple(knots), shares=tuple(map(_share, blocks)))


def _share(block: list[float]) -> float:
    return (block[1] + 0.5) / (block[0] + 1)


# ---- on Spark --------------------------------------------------------------------------


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learnt from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _chosen(rows: DataFrame, limit: int, mark: Column) -> DataFrame:
    """About `limit` rows of each class, all if there are fewer, by a hash from 0 to 2 ** 32 - 1."""
    sizes = dict(rows.groupBy("toxic").count().collect())  # two rows
    bound = F.lit(0)
    for label, size in sizes.items():
        bound = F.when(F.col("toxic") == label, F.lit(int(min(1.0, limit / size) * 2**32))).otherwise(bound)
    return rows.where(F.pmod(mark, F.lit(2**32)) < bound)


def _labelled_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(form, toxic) of (text, toxic): the forms of each text that can be landmarks, each once."""
    claim("toxicity", lambda: None)
    for batch in batches:
        for part in slices(batch, 0):
            some = sentences(part.column(0))
            ends = np.append(some.starts, len(some.words))[some.first]
            out, labels = [], []
            for label, a, b in zip(part.column(1).to_pylist(), ends, ends[1:], strict=False):
                found = [form for c in set(some.words[a:b].tolist()) if 3 <= len(form := some.forms[c]) <= WINDOW]
                out += set(found)
                labels += [label] * (len(out) - len(labels))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(labels, pa.int32())], names=["form", "toxic"])


def _labelled_points(batches: Iterator[pa.RecordBatch], marks: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """(toxic, point, n) of (text, toxic): the point of each sentence with something in common with a landmark, and how
    many others there are."""
    claim("toxicity", lambda: None)
    landmarks = Landmarks(list(marks))
    for batch in batches:
        for part in slices(batch, 0):
            some = sentences(part.column(0))
            which, points = _points(some, landmarks)
            labels = np.repeat(part.column(1).to_numpy(zero_copy_only=False), np.diff(some.first))
            others = np.bincount(np.delete(labels, which), minlength=2)
            arrays = [
                pa.array(np.append(labels[which], [0, 1]), pa.int32()),
                pa.array([*points.tolist(), None, None], pa.list_(pa.float64())),
                pa.array(np.append(np.ones(len(which)), others).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "point", "n"])


def _candidates(sample: DataFrame) -> dict[str, float]:
    """Forms that mark toxic texts, by their evidence, CANDIDATES at most, ties by the form."""
    sizes = dict(sample.groupBy("toxic").count().collect())  # two rows
    n1, n0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    if not n1 or not n0:
        return {}
    forms = sample.mapInArrow(_labelled_forms, "form string, toxic int").groupBy("form")
    forms = forms.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    bad, good = F.col("bad"), F.col("good")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = (bad + good) / (n0 + n1)
    evidence = F.when(bad / n1 > good / n0, 2 * (part(bad, share * n1) + part(good, share * n0))).otherwise(0.0)
    told = forms.select("form", evidence.alias("weight")).where(F.col("weight") >= EVIDENCE)
    return dict(told.orderBy(F.desc("weight"), "form").limit(CANDIDATES).collect())


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_sentences: int = TRAIN_SENTENCES) -> Model:
    """A calibrated machine from `docs` (doc_id, text) and `labels` (doc_id, toxic 0 or 1), held-out rows left out.

    About `train_docs` labelled texts of each class are used, and about `train_sentences` sentences of each class that have
    something in common with a landmark, by hashes; the points of these reach the driver, and a number for each text. A
    text with both labels is toxic. Labels that are null or belong to no text are not used. Without texts of both classes,
    or words that tell them apart, every text gets the share of toxic ones.
    """
    known = labels.where(~is_held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = _chosen(known, train_docs, F.xxhash64("id"))
    texts = docs.select("doc_id", "text")
    # about 2 * train_docs ids; no text is shuffled
    sample = keep(texts.join(F.broadcast(chosen), texts.doc_id == chosen.id).select("text", "toxic"))
    marks = landmarks_of(_candidates(sample))
    model = Model((), np.zeros(0), -1.0)
    if marks:
        found = keep(sample.mapInArrow(lambda b: _labelled_points(b, marks), "toxic int, point array<double>, n bigint"))
        others = dict(found.where("point IS NULL").groupBy("toxic").agg(F.sum("n")).collect())  # two rows
        # equal points have equal hashes, so a number makes them differ
        near = found.where("point IS NOT NULL").withColumn("n", F.monotonically_increasing_id())
        rows = _chosen(near, train_sentences, F.xxhash64("point", "n")).collect()
        points = np.array([r.point for r in rows] + [[0.0] * len(marks)] * len(others)).reshape(-1, len(marks))
        toxic = np.array([r.toxic == 1 for r in rows] + [label == 1 for label in others], dtype=bool)
        model = train(marks, points, toxic, np.array([1.0] * len(rows) + list(map(float, others.values()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch, 0):
                margins = pa.array(scorer.margins(part.column(0)))
                yield pa.RecordBatch.from_arrays([margins, part.column(1)], names=["margin", "toxic"])

    seen = sample.mapInArrow(run, "margin double, toxic int").collect()  # about 2 * train_docs rows
    return calibrated(model, np.array([r.margin for r in seen]), np.array([r.toxic == 1 for r in seen], dtype=bool))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of `docs` (doc_id, text); null and empty texts get the score of no word at all.

    Repeated rows come out as often as they went in; no rows give no rows. Other columns play no part.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch, 1):
                scores = pa.array(model.score(scorer.margins(part.column(1))))
                yield pa.RecordBatch.from_arrays([part.column(0), scores], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, that a machine fitted on `labelled` scores below `threshold`."""
    model = fit(labelled, labels)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch, place):
                yield part.filter(pa.array(model.score(scorer.margins(part.column(place))) < threshold))

    return docs.mapInArrow(run, docs.schema)
