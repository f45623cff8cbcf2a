import pytest

from pagetrail.llm import licences, queries

SF = "/root/testdata/sf0.01"
LINES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
}


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_templates_and_variants(model):
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            assert model.classify(text)[0] == family
            assert model.classify(f"Note: {text.upper()} Thanks.")[0] == family
    assert model.classify("Code is released under the terms of the MIT license, see there.")[0] == "MIT"


def test_unknown_and_none(model):
    for text in ("Licensed under the Frobnicate License, Version 7.1.", "Released under the Wibble Public License."):
        assert model.classify(text)[0] == licences.UNKNOWN
    for text in ("", "The weather is fine, and this is the end of it.", "Version 2.0 of the program works.", "x" * 9999):
        assert model.classify(text)[0] == licences.NONE


MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)


@pytest.mark.parametrize(
    ("text", "family"),
    [
        (MIT_WARRANTY, "MIT"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense"),
        ("Licensed under the GNU Affero General Public License version 3", "AGPL-3.0"),
        ("This software is distributed under the BSD 2-Clause License", "BSD-2-Clause"),
        ("This software is distributed under the BSD 3-Clause License", "BSD-3-Clause"),
        ("This program is licensed under the GNU General Public License, version 2", "GPL-2.0"),
        ("This program is licensed under the GNU General Public License, version 3.0", "GPL-3.0"),
        ("Licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0"),
        ("made available under the terms of the Eclipse Public License 2.0", "EPL-2.0"),
        ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted", "ISC"),
        ("rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell", "MIT"),
        ("Redistributions of source code must retain the above copyright notice", "BSD"),
        ("This project is released under the terms of the Apache License, Version 2.0, see the file.", "Apache-2.0"),
    ],
)
def test_bodies_and_other_wordings(model, text, family):
    assert model.classify(text)[0] in (family, licences.UNKNOWN)
    # what the templates say is found by name
    if family not in ("GPL-3.0", "Apache-2.0", "AGPL-3.0"):
        assert model.classify(text)[0] == family


@pytest.mark.parametrize("text", [
    "This work is licensed under the GNU General Public License, version 4.", "Licensed under the Apache License, Version 1.1.",
    "Distributed under the BSD 4-Clause License.", "Licensed under CC BY-ND 4.0.", "Licensed under CC BY-NC-SA 3.0.",
])
def test_neighbours_are_unknown(model, text):
    assert model.classify(text)[0] == licences.UNKNOWN


def test_calibration(model):
    assert all(0 <= model.classify(t)[1] <= 1 for ts in licences.TEMPLATES.values() for t in ts)
    assert 0.2 <= model.temperature <= 5


def test_rows(spark, documents, model):
    rows = [(1, None), (1, ""), (None, "Text.\n\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0."), (2, "a\n" * 9999)]
    found = licences.scanned(documents(rows).withColumnRenamed("lang", "licences"), model).collect()
    assert [(r.doc_id, r.licences, r.n_unknown, r.n_paragraphs) for r in found] == [
        (1, [], 0, 0),
        (1, [], 0, 0),
        (None, ["CC-BY-NC-4.0", "MIT"], 0, 3),
        (2, [], 0, 9999),
    ]
    assert [(f.place, f.licence) for f in found[2].finds] == [(1, "MIT"), (2, "CC-BY-NC-4.0")]
    assert licences.scanned(documents([]), model).collect() == []
    assert licences.fit(documents([])).classify("Released under the MIT License.")[0] == "MIT"


def test_query_against_plain_search(spark):
    found = {r.doc_id: (r.licences, r.n_unknown) for r in queries.licence_scan(spark, SF).collect()}
    for doc, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        expected = {family for line, family in LINES.items() if line in text.split("\n")}
        assert found[doc] == (sorted(expected), 0), doc
