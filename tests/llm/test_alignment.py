"""Alignment against both libraries run on whole texts, and the laws of fragments."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import alignment as al
from tidemark.llm.queries import BYTE_LEVEL, PIECES_MODEL

NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tokenizers():
    return al.Tokenizers.load(BYTE_LEVEL, PIECES_MODEL)


def plain(texts, tokenizers):
    first, second = tokenizers.sides()
    links, written = [], []
    for text in texts:
        a, b = (first.encode([text])[0], second.encode([text])[0]) if text else ([], [])
        wanted = (" " + (text or "")).encode()
        if any(b"".join(side.names[i] for i in ids) != wanted for side, ids in ((first, a), (second, b))):
            a, b = [], []
        spans = []
        for side, ids in ((first, a), (second, b)):
            ends = np.cumsum([len(side.names[i]) for i in ids]).tolist() if ids else []
            spans.append(list(zip([0, *ends[:-1]], ends, ids, strict=True)) if ids else [])
        own, j = [], 0
        for s, e, i in spans[0]:
            while j and spans[1][j - 1][1] > s:
                j -= 1
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                own.append((i, spans[1][k][2]))
                k += 1
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [([], []) for _ in cuts]
        for side in (0, 1):
            at = 0
            for _, e, i in spans[side]:
                while cuts[at] < e:
                    at += 1
                groups[at][side].append(str(i))
        text_of = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)
        links.append(own)
        written.append((len(a), len(b), len(groups), hashlib.sha256(text_of.encode()).hexdigest() if a else ""))
    counts = collections.Counter(p for own in links for p in own)
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (n_a, n_b, n_g, len(own), sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own), sha)
        for own, (n_a, n_b, n_g, sha) in zip(links, written, strict=True)
    ]


def texts():
    rng = random.Random(11)
    words = ["the", "unbelievable", "naïve", "日本語", "🙂", "don't", "x1y2", "<|endoftext|>", "<s>", "</s>", "A", "…", "ÀÉ", " ", "''", "123,456"]
    odd = [None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "▁", "x▁y z", "\x00", "a\x00b", "é", "ﬁ ½", "﻿x", "日本" * 300, "\n" * 500, "ab" * 2000, "\t \t" * 100]
    long = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", "\n\n ", "", "\t", ". "]) for _ in range(rng.randint(1, 400))) for _ in range(40)]
    return odd + long + ["▁ " + long[0], long[1] + " end▁"] + long[:5]


@pytest.mark.parametrize("segment, range_size, sent", [(1 << 16, 1 << 14, 1 << 19), (100, 32, 1 << 19), (40, 7, 10), (1, 1, 0)])
def test_alignment_is_brute_force(spark, tokenizers, monkeypatch, segment, range_size, sent):
    monkeypatch.setattr(al, "SENT", sent)
    every = texts()
    docs = spark.createDataFrame([(k, t, "clash", b"x") for k, t in enumerate(every)], "doc_id int, text string, uid string, links binary").repartition(3)
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in al.align(docs, tokenizers, segment=segment, range_size=range_size).collect()}
    want = plain(every, tokenizers)
    assert [k for k in range(len(every)) if got[k] != want[k]] == []


def test_whole_table(spark, tokenizers, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in al.align(docs, tokenizers).collect()}
    assert got == dict(zip([r.doc_id for r in rows], plain([r.text for r in rows], tokenizers), strict=True))


def test_odd_tables(spark, tokenizers):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert al.align(docs, tokenizers).collect() == []
    twice = spark.createDataFrame([(7, "same row")] * 2 + [(None, "same row"), (8, None)], docs.schema)
    got = al.align(twice, tokenizers).collect()
    assert sorted((r.doc_id is None, r.n_a > 0) for r in got) == [(False, False), (False, True), (False, True), (True, True)]


def test_fragments_are_a_monoid():
    rng = random.Random(4)
    for _ in range(200):
        total = rng.randint(1, 60)
        ends = [sorted({total, *rng.sample(range(1, total + 1), rng.randint(0, total - 1))}) for _ in range(2)]
        ids = [[rng.randint(0, 99) for _ in e] for e in ends]
        sides = [(np.array(i), np.array(e)) for i, e in zip(ids, ends, strict=True)]
        whole, a, b = al.fragment(*sides[0], *sides[1], head=True)
        borders = sorted({0, total, *rng.sample(range(total + 1), rng.randint(0, min(5, total)))})
        parts, closed = [], []
        for lo, hi in zip(borders, borders[1:], strict=False):
            own = [x for i, e in sides for k in [(e > lo) & (e <= hi)] for x in (i[k], e[k])]
            f, fa, fb = al.fragment(*own, head=lo == 0)
            parts.append(f)
            closed.append((fa, fb))
        while len(parts) > 1:  # any order of joining neighbours
            k = rng.randrange(len(parts) - 1)
            parts[k : k + 2] = [al.join(parts[k], parts[k + 1])]
        assert (parts[0].text, parts[0].groups) == (whole.text, whole.groups)
        # Links closed by joins and links of closed groups make up all links.
        assert sum(len(x) for x in parts[0].links) == len(np.union1d(*ends)) - inner_links(borders, sides)


def inner_links(borders, sides):
    """Token ends between the first and the last common end of each range; behind 0 in the first."""
    n = 0
    for lo, hi in zip(borders, borders[1:], strict=False):
        own = [{x for x in e.tolist() if lo < x <= hi} for _, e in sides]
        common = own[0] & own[1]
        if common:
            n += sum((lo == 0 or x > min(common)) and x <= max(common) for x in own[0] | own[1])
    return n
