"""Licence scans by a trained paragraph classifier, calibrated, with its finds held against templates.

Paragraphs are lines. Their features are word n-grams; a multinomial logistic regression tells the licence families,
licences of no known family ("unknown") and text that is no licence apart. It is trained on variants of the templates, on
variants whose telling words are replaced by words of the corpus, and on a bounded sample of the corpus. A temperature
fitted on variants held back makes its probabilities honest. A family counts as found only if its probability reaches
CERTAIN and the paragraph shares enough word pairs with one of the family's templates; a licence that fails either is
unknown.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices and paragraphs of well-known licences.
AS_IS = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
FREE_PROGRAM = (
    "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by "
    "the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
        AS_IS,
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
        "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, "
        "publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or "
        "Object form.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        FREE_PROGRAM.format(";", "General Public License", "2"),
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        FREE_PROGRAM.format(":", "General Public License", "3"),
    ],
    "LGPL-2.1": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        FREE_PROGRAM.format(";", "Lesser General Public License", "2.1"),
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        FREE_PROGRAM.format(":", "Lesser General Public License", "3"),
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        FREE_PROGRAM.format(":", "Affero General Public License", "3"),
    ],
    "BSD-2-Clause": [
        "Distributed under the BSD 2-Clause License.",
        "Use of this source code is governed by the Simplified BSD 2-Clause license.",
    ],
    "BSD-3-Clause": [
        "Distributed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ],
    #: what both of them say
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at",
        "Licensed under the Eclipse Public License, version 2.0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
        "copyright interest in the software to the public domain.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal."],
}
#: Words that tell licences of otherwise equal wording apart; version numbers do so too.
TELLING = frozenset(
    "affero lesser noncommercial noderivatives sharealike attribution attribution-noncommercial attribution-sharealike "
    "attribution-noderivatives by by-nc by-sa by-nd by-nc-sa by-nc-nd 2-clause 3-clause 4-clause".split()
)
NUMBER = re.compile(r"v?(\d+(?:\.\d+)*)")
NONE, UNKNOWN = "none", "unknown"
GRAMS = 3
WORDS = re.compile(r"[^\W_]+(?:[.+-][^\W_]+)*")
#: Paragraphs of the corpus to train on, about, chosen by a hash; the words of it that stand in COMMON of them or more are
#: features too.
SAMPLE, COMMON = 1500, 5
#: Variants of a template, and training steps.
VARIANTS, STEPS = 24, 150
#: Characters of a paragraph of the background at most; `SAMPLE` of them reach the driver.
LONGEST = 4000
SEED = 17
CERTAIN = 0.5
#: Share of the word pairs of the shorter of paragraph and template that the other must have.
CONFIRMED = 0.6


def words(paragraph: str) -> list[str]:
    return WORDS.findall(paragraph.lower())


def grams(found: list[str], vocabulary: dict[tuple[str, ...], int] | None = None) -> set:
    """Word n-grams of up to GRAMS words; numbers of the known ones if there is a vocabulary."""
    if vocabulary is None:
        return {tuple(found[i : i + n]) for n in range(1, GRAMS + 1) for i in range(len(found) - n + 1)}
    out = set()
    known = [(w,) in vocabulary for w in found]
    for i, first in enumerate(known):
        if first:
            out.add(vocabulary[(found[i],)])
            for n in range(2, GRAMS + 1):
                if i + n > len(found) or not known[i + n - 1]:
                    break
                number = vocabulary.get(tuple(found[i : i + n]))
                if number is not None:
                    out.add(number)
    return out


def telling(found: list[str]) -> set[str]:
    """The words and version numbers that tell licences apart; 3 and 3.0 are the same."""
    numbers = (NUMBER.fullmatch(word) for word in found)
    return {n[1].removesuffix(".0") for n in numbers if n} | TELLING.intersection(found)


def _pairs(found: list[str]) -> set[tuple[str, str]]:
    return set(zip(found, found[1:], strict=False))


@dataclass
class Model:
    classes: list[str]
    vocabulary: dict[tuple[str, ...], int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def __post_init__(self) -> None:
        self.marks = {name: [(_pairs(words(t)), telling(words(t))) for t in texts] for name, texts in TEMPLATES.items()}

    def logits(self, found: list[str]) -> np.ndarray:
        numbers = list(grams(found, self.vocabulary))
        return (self.weights[numbers].sum(axis=0) if numbers else 0) + self.bias

    def confirmed(self, family: str, found: list[str]) -> bool:
        """Whether the paragraph shares enough word pairs with a template of the family, has all of its telling words and
        numbers, and no telling words of another."""
        own, told = _pairs(found), telling(found)
        return any(
            len(own & pairs) >= CONFIRMED * min(len(pairs), max(len(own), 3)) and marks <= told and told & TELLING <= marks
            for pairs, marks in self.marks[family]
        )

    def classify(self, paragraph: str) -> tuple[str, float]:
        """(class, its probability) of one paragraph."""
        found = words(paragraph)
        scaled = self.logits(found) / self.temperature
        chances = np.exp(scaled - scaled.max())
        chances /= chances.sum()
        best = int(chances.argmax())
        name, chance = self.classes[best], float(chances[best])
        if name in (NONE, UNKNOWN):
            return name, chance
        if chance >= CERTAIN and self.confirmed(name, found):
            return name, chance
        return UNKNOWN, 1.0 - float(chances[self.classes.index(NONE)])


def _examples(background: list[list[str]], random: np.random.Generator) -> tuple[list[list[str]], list[str]]:
    """Variants of every template, of licences of no known family, and the background.

    Unknown ones are templates whose telling words and numbers, and names, are others: words that no other family has.
    """
    spare = sorted({w for p in background for w in p if len(w) > 2}) or ["lorem", "ipsum", "dolor", "amet"]
    of_family = {name: {w for t in texts for w in words(t)} for name, texts in TEMPLATES.items()}
    own = {name: found - set().union(*(f for n, f in of_family.items() if n != name)) for name, found in of_family.items()}
    pick = lambda n: [spare[i] for i in random.integers(len(spare), size=n)]
    made, labels = [], []
    for name, texts in TEMPLATES.items():
        for text in texts:
            base, told = words(text), telling(words(text))
            for i in range(VARIANTS):
                # what tells families apart is never left out
                kept = [w for w in base if i == 0 or telling([w]) & told or w in own[name] or random.random() > 0.1]
                kept = [w + ".0" if w.isdigit() and i % 5 == 4 else w for w in kept]
                if i % 2 and len(base) > 24:  # a line of a paragraph that was wrapped
                    start = int(random.integers(len(base) - 12))
                    kept = base[start : start + int(random.integers(10, 16))]
                around = [pick(random.integers(0, 7)) if i % 3 else [], pick(random.integers(0, 7)) if i % 2 else []]
                made.append([*around[0], *kept, *around[1]])
                labels.append(name)
            for _ in range(VARIANTS // 3):
                changed = [
                    str(random.integers(5, 30)) if NUMBER.fullmatch(w) else pick(1)[0] if w in own[name] or w in TELLING or random.random() < 0.2 else w
                    for w in base
                ]
                if changed != base and {"license", "licensed", "permission", "redistribution", "cc"} & set(changed):
                    made.append(changed)
                    labels.append(UNKNOWN)
    return made + background, labels + [NONE] * len(background)


def train(background: list[str]) -> Model:
    """A calibrated model; `background` are paragraphs of the corpus, those that name a licence left out."""
    random = np.random.default_rng(SEED)
    probe = Model([], {}, np.zeros((0, 0)), np.zeros(0))
    others = [w for w in map(words, background) if w and not any(probe.confirmed(f, w) for f in TEMPLATES)] or [["lorem", "ipsum"]]
    made, labels = _examples(others, random)
    classes = [*TEMPLATES, UNKNOWN, NONE]
    known = {g for texts in TEMPLATES.values() for t in texts for g in grams(words(t))}
    seen = Counter(w for p in others for w in set(p))
    known |= {(w,) for w, n in seen.items() if n >= COMMON}
    vocabulary = {g: i for i, g in enumerate(sorted(known))}
    features = [sorted(grams(paragraph, vocabulary)) or [len(vocabulary)] for paragraph in made]
    y = np.array([classes.index(c) for c in labels])
    held = random.random(len(y)) < 0.2
    aim = np.eye(len(classes))[y]
    weight = (1 / np.bincount(y[~held], minlength=len(classes)).clip(1))[y][:, None] / len(classes)
    weight[held] = 0
    # paragraphs by feature and features by paragraph, one behind the other; one more weight, always 0, is that of none
    flat, sizes = np.concatenate(features), np.array([len(f) for f in features])
    starts, row = np.concatenate([[0], np.cumsum(sizes)])[:-1], np.repeat(np.arange(len(features)), sizes)
    order = np.argsort(flat, kind="stable")
    present, first = np.unique(flat[order], return_index=True)
    w, b = np.zeros((len(vocabulary) + 1, len(classes))), np.zeros(len(classes))
    speed = [np.zeros_like(w), np.zeros_like(b)]
    for _ in range(STEPS):
        z = np.add.reduceat(w[flat], starts) + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        miss = weight * (p / p.sum(axis=1, keepdims=True) - aim)
        slope = 1e-5 * w
        slope[present] += np.add.reduceat(miss[row[order]], first)
        slope[-1] = 0
        speed = [0.9 * speed[0] - 2.0 * slope, 0.9 * speed[1] - 2.0 * miss.sum(axis=0)]
        w, b = w + speed[0], b + speed[1]
    z = (np.add.reduceat(w[flat], starts) + b)[held]

    def loss(t: float) -> float:
        s = z / t - (z / t).max(axis=1, keepdims=True)
        return float(-(s[np.arange(len(s)), y[held]] - np.log(np.exp(s).sum(axis=1))).mean())

    temperature = min(np.geomspace(0.2, 5, 41).tolist(), key=loss) if held.any() else 1.0
    return Model(classes, vocabulary, w[:-1], b, temperature)


def paragraphs(text: str | None) -> list[str]:
    return [line for line in (text or "").split("\n") if line.strip()]


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model with about `sample` different paragraphs of `docs` as background, chosen by a hash; longer ones than
    LONGEST characters are left out of it."""
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line")).where("line rlike '[^ ]'")
    lines = lines.where(F.length("line") <= LONGEST)
    mark = F.pmod(F.xxhash64("line"), F.lit(2**32))
    share = min(1.0, 1.2 * sample / max(lines.count(), 1))
    # equal lines have equal marks; so few rows, not some of every task, reach the driver
    chosen = lines.where(mark < int(share * 2**32)).distinct().orderBy(mark, "line").limit(sample).collect()
    return train([r.line for r in chosen])


def scanned(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, licences, n_unknown, n_paragraphs, finds) of every row of `docs` (doc_id, text).

    licences: the families found, sorted; n_unknown: paragraphs with a licence of no known or confirmed family;
    n_paragraphs: lines that are not blank; finds: (place among them, class, probability) of those with a licence. Null
    and empty texts have no paragraphs. Repeated rows come out as often as they went in; no rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found_type = pa.list_(pa.struct([("place", pa.int64()), ("licence", pa.string()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, float]] = {}
        for batch in batches:
            rows = []
            for text in batch.column(1):
                finds = []
                every = paragraphs(text.as_py())
                for place, paragraph in enumerate(every):
                    name, chance = known.get(paragraph) or model.classify(paragraph)
                    if name != NONE:
                        if len(known) < 10_000:
                            known[paragraph] = name, chance
                        finds.append({"place": place, "licence": name, "probability": chance})
                names = [f["licence"] for f in finds]
                rows.append((sorted({*names} - {UNKNOWN}), names.count(UNKNOWN), len(every), finds))
            if rows:
                kinds = [pa.list_(pa.string()), pa.int64(), pa.int64(), found_type]
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["doc_id", "licences", "n_unknown", "n_paragraphs", "finds"]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    schema = f"doc_id {kind}, licences array<string>, n_unknown bigint, n_paragraphs bigint, "
    schema += "finds array<struct<place:bigint,licence:string,probability:double>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
