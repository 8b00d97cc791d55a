"""Quality rules by weak supervision.

Each rule votes good (1) or bad (-1) on a document, or abstains (0). Nobody knows the truth; expectation
maximisation over the votes of the whole corpus estimates how often each rule is right about good and
about bad documents, and how common good ones are. A document's posterior probability of being good
decides, not the demand that all rules pass. The corpus enters EM as counts of vote patterns, of which
there are at most 3 to the number of rules, whatever the number of documents.

Defined results: null text has no words, all counts 0, and fails; a rule abstains where its measure has
no denominator; repeated rows count each; other columns are not carried. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.words import WORD, let, words
from tidemark.workspace import materialise

RULES = ("length", "repetition", "symbols", "lines", "word_length", "capitals", "letters", "single")


def _repeat_words(grams: Column) -> Column:
    """Words covered by windows of three that occur twice or more. `grams`: a hash for each window."""
    by_hash = F.array_sort(F.transform(grams, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def equal_neighbours(s: Column) -> Column:
        n = F.size(s) - 1
        return F.zip_with(
            F.slice(s, F.lit(1), n), F.slice(s, F.lit(2), n),
            lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
        )

    starts = F.array_distinct(F.flatten(let(by_hash, equal_neighbours)))
    covered = F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))
    distinct = F.size(F.array_distinct(grams))
    return F.when(distinct < F.size(grams), F.size(F.array_distinct(covered))).otherwise(0)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the counts the rules work on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    filled = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    split = docs.select(
        "doc_id", text.alias("text"), words(F.col("text")).alias("w"), filled.alias("filled")
    )
    n = F.size("w")
    grams = F.when(
        n > 2,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.col("w")[i], F.col("w")[i + 1], F.col("w")[i + 2]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("filled").cast("long").alias("n_filled"),
        (F.size("filled") - F.size(F.array_distinct("filled"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("[a-z]")).cast("long").alias("n_lower"),
        F.regexp_count("text", F.lit(r"[^\p{L}\x20\x09-\x0D]")).cast("long").alias("n_other"),
        F.size(F.filter("w", lambda x: F.length(x) == 1)).cast("long").alias("n_single"),
        grams.alias("grams"),
    )
    return counted.withColumn("n_repeat_words", _repeat_words(F.col("grams")).cast("long")).drop("grams")


def _vote(good: Column, bad: Column) -> Column:
    """Null conditions abstain."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules. Shares are compared in whole numbers."""
    c = {k: F.col(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_filled")}
    letters = F.col("n_upper") + F.col("n_lower")
    some, n = c["n_words"] > 0, c["n_words"]
    return dict(zip(RULES, (
        _vote(n >= 100, n < 20),
        _vote(some & (c["n_repeat_words"] * 100 <= n * 20), c["n_repeat_words"] * 100 > n * 50),
        _vote(some & (c["n_symbols"] * 100 <= n * 10), c["n_symbols"] * 100 > n * 40),
        _vote(some & (c["n_dup_lines"] * 100 <= c["n_filled"] * 10), c["n_dup_lines"] * 100 > c["n_filled"] * 50),
        _vote(some & (c["word_chars"] >= 3 * n) & (c["word_chars"] <= 12 * n), (c["word_chars"] < 2 * n) | (c["word_chars"] > 20 * n)),
        _vote((letters > 0) & (F.col("n_upper") * 100 <= letters * 30), (letters > 0) & (F.col("n_upper") * 100 > letters * 70)),
        _vote(some & (F.col("n_other") * 100 <= c["word_chars"] * 15), some & (F.col("n_other") * 100 > c["word_chars"] * 25)),
        _vote(some & (F.col("n_single") * 100 <= n * 20), some & (F.col("n_single") * 100 > n * 35)),
    ), strict=True))


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> dict:
    """EM. patterns: votes and how many documents cast them. Gives `prior` of good and, for each rule,
    `right`: the probability that a vote on a good and on a bad document is right."""
    patterns = sorted(patterns)
    n = len(RULES)
    # At first, a bad vote is taken to be rarely wrong, and a good one to say little: most rules look for
    # one kind of fault each, and a document with one fault passes the others.
    prior, right = 0.7, [(0.98, 0.25)] * n
    total = sum(k for _, k in patterns)
    for _ in range(rounds if total else 0):
        good_sum, hits = 0.0, [[4.9, 5.0, 1.25, 5.0] for _ in range(n)]  # the same belief, worth five votes
        for vote, k in patterns:
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, _log_odds(prior, right, vote)))))
            good_sum += k * p
            for h, v in zip(hits, vote, strict=True):
                if v:
                    h[0] += k * p * (v > 0)
                    h[1] += k * p
                    h[2] += k * (1 - p) * (v < 0)
                    h[3] += k * (1 - p)
        prior = min(0.99, max(0.01, good_sum / total))
        # No vote of a rule may speak for its opposite: that keeps good from meaning bad, and nothing else does.
        right = []
        for h in hits:
            g = min(0.998, max(0.5, h[0] / h[1]))
            right.append((g, min(0.99, max(0.02, 1 - g, h[2] / h[3]))))
    return {"prior": prior, "right": right}


def _log_odds(prior: float, right: list[tuple[float, float]], vote: tuple[int, ...]) -> float:
    odds = math.log(prior / (1 - prior))
    for (g, b), v in zip(right, vote, strict=True):
        odds += math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b) if v < 0 else 0.0
    return odds


def judge(docs: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """doc_id, the counts, a vote column for each rule, `posterior` and `good`."""
    measured = measure(docs)
    cast = materialise(measured.withColumns({f"vote_{k}": v for k, v in votes().items()}), "votes")
    names = [f"vote_{k}" for k in RULES]
    counted = cast.groupBy(*names).count().collect()  # at most 3 to the number of rules
    model = fit_votes([(tuple(r[k] for k in names), r["count"]) for r in counted])
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for name, (g, b) in zip(names, model["right"], strict=True):
        odds += F.when(F.col(name) > 0, math.log(g / (1 - b))).when(F.col(name) < 0, math.log((1 - g) / b)).otherwise(0.0)
    return cast.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn("good", F.col("posterior") >= threshold)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
