"""License scans against a plain search, and the expression parser by examples."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses
from tidemark.llm.queries import op11_licenses

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    places = sorted((i, label) for p, label in BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    return len(words), places


def test_query_is_brute_force(spark, medium):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    rows = op11_licenses(spark, medium).collect()
    assert len(rows) == len(texts) and sum(r.n_base for r in rows) > 5
    for r in rows:
        n, places = plain(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert {x for _, x in places} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)


ODD = [
    None, "", "...", "MIT License", "the mit\n\tLICENSE; mit license", "mit licenses", "GNU general/public License", "é MIT License é",
    "cc by cc by sa", "Mit-license apache_license", "Apache License\x00Apache License", "x" * 70_000 + " mit license", "a b " * 400_000 + "mit license",
]


def test_odd_texts(spark):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(ODD)] + [(3, ODD[3], "clash"), (None, "MIT License", "clash")], "doc_id bigint, text string, n_words string")
    got = licenses.scan(docs).select("doc_id", "n_words", "places").collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        n, places = plain("MIT License" if r.doc_id is None else ODD[r.doc_id])
        assert (r.n_words, sorted((p.word, p.label) for p in r.places)) == (n, places)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_blocks_lose_nothing(monkeypatch):
    text = "one gnu general public license two SPDX-License-Identifier: MIT OR Apache-2.0\n" * 40
    whole = licenses.scan_text(text.encode())
    for size in (1, 7, 30, 61, 200):
        monkeypatch.setattr(licenses, "BLOCK", size)
        assert licenses.scan_text(text.encode()) == whole
    assert len(whole["places"]) == 40 and len(whole["expressions"]) == 40


@pytest.mark.parametrize("text, order, whole", [
    ("MIT", "MIT", True),
    ("MIT OR Apache-2.0 AND BSD-3-Clause", "MIT Apache-2.0 BSD-3-Clause and or", True),
    ("(MIT or Apache-2.0) and BSD-3-Clause", "MIT Apache-2.0 or BSD-3-Clause and", True),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", "GPL-2.0-only Classpath-exception-2.0 with MIT or", True),
    ("MIT License", "MIT", True),
    ("MIT)", "MIT", True),
    ("MIT OR", "MIT", False),
    ("MIT AND (GPL-3.0 OR", "MIT GPL-3.0 and", False),
    ("((MIT", "MIT", False),
    ("OR MIT", "", False),
    ("()", "", False),
])
def test_postfix(text, order, whole):
    assert licenses.postfix(iter(re.findall(r"[()]|[^\s()]+", text))) == (order.split(), whole)


@pytest.mark.parametrize("text, labels, terms", [
    ("MIT OR GPL-3.0-or-later", {"mit", "gpl"}, "permissive"),
    ("MIT AND GPL-3.0-or-later", {"mit", "gpl"}, "copyleft"),
    ("GPL-2.0 WITH Classpath-exception-2.0", {"gpl"}, "weak copyleft"),
    ("(AGPL-3.0 OR Apache-2.0) AND CC-BY-NC-4.0", {"agpl", "apache", "cc-by-nc"}, "restricted"),
    ("CC-BY-SA-4.0 AND LicenseRef-own", {"cc-by-sa"}, "copyleft"),
    ("LGPL-2.1+", {"lgpl"}, "weak copyleft"),
])
def test_evaluation(text, labels, terms):
    found = licenses.scan_text(f"x\nSPDX-License-Identifier: {text}\nnot this: MIT".encode())
    (word, expression, whole, of, heaviest), = found["expressions"]
    assert (word, expression, whole, set(of), licenses.TERMS[heaviest]) == (1, text, True, labels, terms)


def test_notices_and_tags_need_their_place(spark):
    rows = [
        (1, 'license = "Apache-2.0"'), (2, "a license to kill"), (3, "license: unknown-thing"), (4, '"licenses": ["MIT"]'),
        (5, "Permission is hereby granted, free of charge,\n to any person obtaining a copy"), (6, "Creative Commons Attribution-ShareAlike"),
    ]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == {1: ["apache"], 2: [], 3: [], 4: ["mit"], 5: ["mit"], 6: ["cc-by", "cc-by-sa"]}
    assert licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).filter(F.col("score") == 0).count() == 2
