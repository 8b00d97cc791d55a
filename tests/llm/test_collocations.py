"""Collocations against a plain count of all n-grams."""

from __future__ import annotations

import collections
import random
import re

import pytest

from tidemark.llm import collocations as c

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, percent, top):
    found, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, 5):
                found.update((lang, *w[i : i + n]) for i in range(len(w) - n + 1))
    often = {k: f for k, f in found.items() if len(k) > 2 and f >= least}
    inside = {
        (k[0], *k[1 + i : 1 + i + n])
        for k, f in often.items() for n in range(2, len(k) - 1) for i in range(len(k) - n) if 100 * f >= percent * often[(k[0], *k[1 + i : 1 + i + n])]
    }
    out = collections.defaultdict(list)
    for k, a in often.items():
        if k not in inside:
            w = k[1:]
            score, cut = min((2000000 * a // (found[k[:1] + w[:j]] + found[k[:1] + w[j:]]), j) for j in range(1, len(w)))
            out[k[0]].append((-score, -a, " ".join(w).encode(), found[k[:1] + w[:cut]], found[k[:1] + w[cut:]]))
    return {
        (lang, rank, p.decode(), -a, left, right, totals[lang], -s)
        for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    }


def rows():
    rng = random.Random(5)
    vocabulary = ["the", "of", "Été", "été", "new", "York", "times", "a", "b"] + [f"w{k}" for k in range(30)]
    out = []
    for k in range(300):
        words = rng.choices(vocabulary, weights=[20] * 9 + [1] * 30, k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ". ", ", ", "\n", "  "]) for w in words)
        out.append((text + "New York times " * rng.randint(0, 3), rng.choice(["en", "fr", None, "und", "de"])))
    out += [(None, "en"), ("", None), (" .,\n", "en"), ("the of " * 5000, "en"), ("one line\x0btwo", "xx")]
    return out + out[:40]


@pytest.mark.parametrize("sent, hot, held", [(1 << 18, 1 << 10, 1 << 20), (4, 8, 50), (1 << 18, 1 << 30, 200), (0, 1, 1000)])
def test_collocations_are_brute_force(spark, monkeypatch, sent, hot, held):
    monkeypatch.setattr(c, "SENT", sent)  # words with ranks; the rest go by hash
    monkeypatch.setattr(c, "HOT", hot)  # pairs that are dealt out by their third word
    monkeypatch.setattr(c, "HELD", held)
    docs = spark.createDataFrame([(t, g, 1, "x") for t, g in rows()], "text string, lang string, w1 int, score string").repartition(3)
    for least, top in ((3, 40), (30, 2000)):
        got = c.collocations(docs, least=least, top=top).collect()
        assert {tuple(r) for r in got} == plain(rows(), least, 80, top) and len(got) > 10


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert c.collocations(docs).collect() == []
    assert c.collocations(spark.createDataFrame([(1, None, None), (2, "", "en")], docs.schema)).collect() == []


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame([(1, 2, 0, 0, 10**13), (1, 0, 0, 0, 10**13), (2, 0, 0, 0, 3 * 10**13)], "w1 bigint, w2 bigint, w3 bigint, w4 bigint, f bigint")
    assert [r.score for r in c._scored(counts.filter("w2 <> 0"), counts).collect()] == [500000]
