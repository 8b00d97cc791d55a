"""Line dedup, quality rules and mixing: SQL, brute force, and odd input."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, quality_rules

DOCS = "doc_id bigint, text string, lang string, source string, n_lines string, kept string, label string"
SPACE = " \t\n\x0b\x0c\r"


def odd_rows():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(12)]
    lines = ["", "  ", "Shared LINE", " shared line\t", "É", "x | y"] + [" ".join(rng.choices(vocabulary, k=9)) for _ in range(6)]
    rows = [(k, "\n".join(rng.choices(lines, k=rng.randint(1, 6))), "en", f"src{k % 3}", "a", "b", "c") for k in range(40)]
    rows += [(100, None, None, None, None, None, None), (101, "", "en", "src0", "", "", ""), (102, " \n\t", "en", "none", "", "", "")]
    rows += [(103, "same row\nsame row", "fr", "src1", "", "", "")] * 2 + [(None, "w1 w2 w3 " * 30, "en", "src1", "", "", "")]
    return rows + [(104, "w1 w2 w3 w4\n" * 4000, "de", "src2", "", "", "")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


@pytest.mark.parametrize(("min_docs", "batches", "fanout"), [(10, 4, 2), (2, 1, 2), (3, 5, 3)])
def test_line_dedup_is_brute_force(odd, min_docs, batches, fanout):
    rows = odd_rows()
    found = collections.Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    want = collections.Counter()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if found[key(x)] < min_docs]
        text = r[1] if len(kept) == len(lines) else "\n".join(kept)
        want[(r[0], text, len(lines), len(lines) - len(kept), r[5])] += 1
    out = line_dedup.dedup_lines(odd, min_docs=min_docs, batches=batches, fanout=fanout)
    got = collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped, r.kept) for r in out.collect())
    assert got == want


def test_runs_are_compacted(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path), min_docs=3, fanout=2)
    for _ in range(5):
        runs.add(spark.createDataFrame([(1, 1), (2, 2)], "a bigint, b bigint").limit(2))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {tuple(r) for r in runs.frequent().collect()} == {(1, 1), (2, 2)}
    # A later session goes on; what a dead one left unlisted does not count.
    (tmp_path / "level=0" / "run=99").mkdir()
    again = line_dedup.LineRuns(spark, str(tmp_path), min_docs=3, fanout=2)
    assert (again.levels, again.written) == (runs.levels, runs.written)
    for _ in range(3):
        again.add(spark.createDataFrame([(3, 3), (1, 1)], "a bigint, b bigint").limit(2))
    assert [len(level) for level in again.levels] == [0, 0, 0, 1]
    assert {tuple(r) for r in line_dedup.LineRuns(spark, str(tmp_path), min_docs=3, fanout=2).frequent().collect()} == {(1, 1), (2, 2), (3, 3)}


def test_empty_tables(empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    assert quality_rules.judge(empty).count() == 0
    assert mixing.choose(empty, domain=F.lit("d")).count() == 0
    assert mixing.mix(empty, domain=F.lit("d")).columns == empty.columns


def measures(text):
    text = text or ""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    many = collections.Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if many[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measures_are_brute_force(spark, odd, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd.select("doc_id", "text"))
    want = collections.Counter((r.doc_id, *measures(r.text)) for r in docs.collect())
    got = collections.Counter((r.doc_id, *[r[n] for n in NAMES]) for r in quality_rules.measure(docs).collect())
    assert got == want


def test_rules_agree_with_labels(spark, medium):
    judged = quality_rules.judge(spark.read.parquet(f"{medium}/documents.parquet"))
    both = judged.join(spark.read.parquet(f"{medium}/labels.parquet"), "doc_id").filter("n_words >= 50 AND toxic = 0").collect()
    share = {q: sum(r.good for r in both if r.quality == q) / sum(r.quality == q for r in both) for q in (0, 1)}
    assert share[1] > 0.95 and share[0] < 0.5


def test_em_finds_accuracies():
    rng = random.Random(1)
    accuracy = [0.98, 0.99, 0.985, 0.98, 0.98, 0.99, 0.98, 0.99]  # on good documents; 0.7 on bad ones
    cast = collections.Counter()
    for _ in range(4000):
        good = rng.random() < 0.7
        cast[tuple((1 if (rng.random() < (a if good else 0.7)) == good else -1) if rng.random() < 0.8 else 0 for a in accuracy)] += 1
    model = quality_rules.fit_votes(list(cast.items()))
    assert abs(model["prior"] - 0.7) < 0.05
    assert all(abs(g - a) < 0.02 and abs(b - 0.7) < 0.06 for (g, b), a in zip(model["right"], accuracy, strict=True))


@pytest.mark.parametrize("accuracy, on_bad, most_rejected", [
    ([0.85, 0.85, 0.985, 0.985, 0.985, 0.985, 0.985, 0.985], 0.6, 0.02),
    ([0.8, 0.95, 0.85, 0.9, 0.95, 0.9, 0.8, 0.92], 0.7, 0.05),
])
def test_em_finds_rules_that_often_wrong_good_documents(accuracy, on_bad, most_rejected):
    rng = random.Random(1)
    cast, of_good = collections.Counter(), collections.Counter()
    for _ in range(10000):
        good = rng.random() < 0.7
        vote = tuple((1 if (rng.random() < (a if good else on_bad)) == good else -1) if rng.random() < 0.8 else 0 for a in accuracy)
        cast[vote] += 1
        of_good[vote] += good
    model = quality_rules.fit_votes(list(cast.items()))
    assert abs(model["prior"] - 0.7) < 0.03
    assert all(abs(g - a) < 0.03 and abs(b - on_bad) < 0.06 for (g, b), a in zip(model["right"], accuracy, strict=True))
    rejected = sum(k for v, k in of_good.items() if quality_rules._log_odds(model["prior"], model["right"], v) < 0)
    assert rejected < most_rejected * sum(of_good.values())


def test_em_keeps_good_and_bad_apart():
    # Seven of ten documents are bad: every vote must still speak for itself.
    rng = random.Random(2)
    cast = collections.Counter()
    for _ in range(3000):
        good = rng.random() < 0.3
        cast[tuple((1 if (rng.random() < 0.9) == good else -1) if rng.random() < 0.8 else 0 for _ in range(8))] += 1
    model = quality_rules.fit_votes(list(cast.items()))
    assert abs(model["prior"] - 0.3) < 0.05 and all(g >= 0.5 and g + b >= 1 for g, b in model["right"])


def test_mixing_shares_shortages_among_siblings_first(spark):
    leaves = [("a", "en", "s1", 100), ("a", "en", "s2", 1000), ("a", "fr", "s3", 1000), ("b", "en", "s4", 5000)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint")
    got = {r.source: int(r.budget) for r in mixing.leaf_budgets(df, budget_percent=50, max_epochs=1, weights={}).collect()}
    # 3,550 in all, 1,775 to each domain; a: 887 to each language; s1 lacks 343, which its sibling gets.
    assert got == {"s1": 100, "s2": 787, "s3": 887, "s4": 1775}


@pytest.mark.parametrize("repeats", [0, 300])
def test_mixing_is_brute_force(spark, odd, repeats):
    # One doc_id and the missing one hold many rows of many lengths.
    more = [(k % 2 * 7 or None, "w " * (k % 11), "en", f"src{k % 3}", "", "", "") for k in range(repeats)]
    odd = odd.unionByName(spark.createDataFrame(more, DOCS)) if more else odd
    rows = collections.Counter((r[0], r[2], r[3], measures(r[1])[0]) for r in odd_rows() + more)
    chosen = mixing.choose(odd, domain=F.lit("d"), budget_percent=60, max_epochs=2, seed=5)
    budgets = mixing.leaf_budgets(
        odd.select(F.lit("d").alias("domain"), "lang", "source", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")).alias("n"))
        .groupBy("domain", "lang", "source").agg(F.sum("n").alias("tokens")),
        budget_percent=60, max_epochs=2, weights={},
    ).collect()
    want = collections.Counter()
    for b in budgets:
        leaf = [(r, k) for r, k in rows.items() if r[1:3] == (b.lang, b.source)]
        whole, rest = (int(b.budget) // b.tokens, int(b.budget) % b.tokens) if b.tokens else (1, 0)
        by_place = collections.defaultdict(list)  # rows of one place are taken or left together
        for r, k in leaf:
            by_place[hashlib.md5(f"5:{whole}:{'' if r[0] is None else r[0]}".encode()).hexdigest()].append((r, k))
        total = 0
        for place in sorted(by_place):
            total += sum(r[3] * k for r, k in by_place[place])
            copies = whole + (rest > 0 and total <= rest)
            for r, k in by_place[place] if copies else []:
                want[(*r, copies)] += k
    got = collections.Counter((r.doc_id, r.lang, r.source, r.n_tokens, r.copies) for r in chosen.collect())
    assert got == want
    again = mixing.mix(odd, domain=F.lit("d"), budget_percent=60, max_epochs=2, seed=5)
    assert again.count() == sum(k * r[-1] for r, k in want.items()) and again.columns == odd.columns
