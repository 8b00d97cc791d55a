"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: at each word, the word and the three that lead on from it in its
piece, padded where the piece ends. ROLLUP over the four columns sums the counts of successively
shorter prefixes, so each shorter phrase's count is a sum of windows and no n-grams are exploded.

A phrase found `least` times has only words and parts found so often. So windows are padded at words
that are rarer, those without a second word are not counted (single words are counted on their own),
and before the sums each window is cut behind the part that is found less often. Windows are dealt out
by their first two words, so one exchange gives whole counts of pairs and triples; a pair whose words
may hold a large share of all is dealt out by its third word too, and its sums meet in the ROLLUP.

A word of a language has a code: its rank among the `SENT` most frequent, which all tasks know, else a
64-bit hash. While every word found `least` times has a rank, the rest is known to be rarer.

Defined results: null texts are empty, null languages `und`; repeated rows count each; an empty table
gives no rows; phrases of equal score and count are ordered by the bytes of their words. Of other
columns none is carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.frequent import most_frequent
from tidemark.llm.hashing import mix, powers, slices
from tidemark.llm.ship import ship
from tidemark.llm.words import LOWER, UPPER
from tidemark.workspace import materialise

ORDER = 4  # words of the longest phrase
SENT = 1 << 18  # words whose ranks go to all tasks
HELD = 1 << 20  # windows a task counts together
SPLIT = 64  # parts of a pair that may be hot
HOT = 1 << 10  # a pair may be hot if both words are more than one in HOT of all

BREAK = r"[.,;:!?\x0A-\x0D]"
GAP = r"[.,;:!?\x0A-\x0D\x20\x09]+"
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_SOLID = ~_BREAKS
_SOLID[[32, 9]] = False
_CODES = np.random.default_rng(611953).integers(1, 2**64, 256, dtype=np.uint64)
_CODES[65:91] = _CODES[97:123]
_CODES[~_SOLID] = 0


def _language_hash(name: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little"))


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a row of texts: a hash for each word, the text it is in, and whether the next word follows it in its piece."""
    solid = _SOLID[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    begins[heads] = solid[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool)
    up, down = powers(len(data))
    hashes = mix(np.add.reduceat(_CODES[data] * up, starts) * down[starts])
    text = np.searchsorted(bounds, starts, "right") - 1
    breaks = np.cumsum(_BREAKS[data])[starts]
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (breaks[1:] == breaks[:-1]) & (text[1:] == text[:-1])
    return hashes, text, joined


class Ranks:
    """The codes of words: ranks from 1, most frequent first; 0 for words known to be rare; else negative."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, complete: bool, total: int):
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], (order + 1).astype(np.int64)
        self.counts = np.concatenate([[0], counts]).astype(np.int64)
        self.complete, self.hot = complete, max(1, total // HOT)

    def codes(self, keys: np.ndarray) -> np.ndarray:
        rest = np.zeros(len(keys), np.int64) if self.complete else -(keys >> np.uint64(1)).astype(np.int64) - 1
        if not len(self.keys):
            return rest
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.ranks[at], rest)

    def deal(self, w: np.ndarray) -> np.ndarray:
        """-1, or for a pair that may be hot a number from its third word."""
        known = self.counts[np.maximum(w[:, :2], 0)]
        third = mix(w[:, 2].astype(np.uint64)) % np.uint64(SPLIT)
        return np.where(known.min(axis=1) >= self.hot, third.astype(np.int64), -1)


def windows(codes: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """The longest window at each word, padded with 0; only those of two words or more."""
    n = len(codes)
    lead = np.zeros((n, ORDER), np.int64)
    lead[:, 0] = codes
    on = codes != 0
    for k in range(1, ORDER):
        if n > k:
            on = on[: n - k] & joined[k - 1 : n - 1] & (codes[k:] != 0)
            lead[: n - k, k][on] = codes[k:][on]
    return lead[lead[:, 1] != 0]


def _counted(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.concatenate(found)
    rows = rows[np.lexsort(rows.T[::-1])]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])) if len(rows) else np.empty(0, int)
    return rows[first], np.diff(np.append(first, len(rows)))


def _keys(hashes: np.ndarray, languages: np.ndarray) -> np.ndarray:
    return mix(hashes ^ languages)


def _window_counts(docs: DataFrame, ranks: Ranks) -> DataFrame:
    """w1 to w4, deal and n: partial counts of the longest windows."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)  # at most SENT words

    def rows(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        w, n = _counted(found)
        deal = sent.value.deal(w)
        for a in range(0, len(w), 100_000):
            part = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(w[part, k]) for k in range(ORDER)), pa.array(deal[part]), pa.array(n[part].astype(np.int64))],
                [*(f"w{k + 1}" for k in range(ORDER)), "deal", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size, languages = [], 0, {}
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for x in set(names) - languages.keys():
                languages[x] = _language_hash(x)
            for first, end, data, bounds in slices(batch.column("text")):
                if not len(data):
                    continue
                hashes, text, joined = words_of(data, bounds)
                of = np.array([languages[x] for x in names[first:end]], np.uint64)
                own = windows(sent.value.codes(_keys(hashes, of[text])), joined)
                found.append(own)
                size += len(own)
                if size >= HELD:
                    yield from rows(found)
                    found, size = [], 0
        if found:
            yield from rows(found)

    columns = ", ".join(f"w{k + 1} bigint" for k in range(ORDER))
    return docs.mapInArrow(run, f"{columns}, deal bigint, n bigint")


def _coded(words: DataFrame, ranks: Ranks) -> DataFrame:
    """lang, word, f and the word's code."""
    sent = words.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = sent.value.codes(_word_keys(batch.column("word"), batch.column("lang")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes)], ["lang", "word", "f", "code"])

    return words.select("lang", "word", "f").mapInArrow(run, "lang string, word string, f bigint, code bigint")


def _word_keys(words: pa.Array, languages: pa.Array) -> np.ndarray:
    """Keys of words that are texts of their own."""
    found = [np.empty(0, np.uint64)]
    for _, _, data, bounds in slices(words):
        found.append(words_of(data, bounds)[0])
    hashes, names = np.concatenate(found), languages.to_pylist()
    of = {x: _language_hash(x) for x in set(names)}
    return _keys(hashes, np.array([of[x] for x in names], np.uint64))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word and f: how often each word stands in texts of each language."""
    low = F.translate("text", UPPER, LOWER)
    words = docs.select("lang", F.explode(F.array_remove(F.split(low, GAP), "")).alias("word"))
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f"))


def phrase_counts(parts: DataFrame, least: int) -> DataFrame:
    """w1 to w4, padded with 0, and f of all phrases of two words or more found `least` times."""
    pair, triple = ["w1", "w2", "deal"], ["w1", "w2", "deal", "w3"]
    whole = parts.repartition(*pair).groupBy(*triple, "w4").agg(F.sum("n").alias("n"))
    whole = whole.withColumn("of_triple", F.sum("n").over(Window.partitionBy(*triple)))
    whole = whole.withColumn("of_pair", F.sum("n").over(Window.partitionBy(*pair)))
    # A pair that was split is kept: its parts meet below.
    often = whole.filter((F.col("of_pair") >= least) | (F.col("deal") >= 0))
    third, fourth = F.col("of_triple") >= least, F.col("n") >= least
    cut = often.select(
        *pair, F.when(third, F.col("w3")).otherwise(0).alias("w3"), F.when(third & fourth, F.col("w4")).otherwise(0).alias("w4"), "n"
    ).groupBy(*triple, "w4").agg(F.sum("n").alias("n"))
    level = F.grouping_id().alias("level")
    sums = cut.rollup("w1", "w2", "w3", "w4").agg(F.sum("n").alias("f"), level)
    ends_in_a_word = ((F.col("level") == 0) & (F.col("w4") != 0)) | ((F.col("level") == 1) & (F.col("w3") != 0)) | (F.col("level") == 3)
    zero = [F.coalesce(f"w{k}", F.lit(0)).alias(f"w{k}") for k in (3, 4)]
    return sums.filter(ends_in_a_word & (F.col("f") >= least)).select("w1", "w2", *zero, "f")


def _part(first: int, end: int) -> Column:
    """Words `first` to `end` of the four columns as a phrase of its own, padded."""
    kept = [F.col(f"w{k}") for k in range(first, end + 1)]
    return F.struct(*[(kept[k] if k < len(kept) else F.lit(0).cast("long")).alias(f"w{k + 1}") for k in range(ORDER)])


def _within(percent: int, counts: DataFrame) -> DataFrame:
    """The phrases inside a longer one that is found `percent` of as often, with that one's count."""
    def parts(size: int) -> Column:
        return F.array(*[_part(a, a + n - 1) for n in range(2, size) for a in range(1, size - n + 2)])

    size = F.when(F.col("w4") != 0, parts(4)).when(F.col("w3") != 0, parts(3))
    return counts.filter("w3 <> 0").select(F.explode(size).alias("part"), "f").groupBy("part").agg(F.max("f").alias("longer"))


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Each candidate's lowest cut: w1 to w4, a, l, r, score."""
    def cuts(size: int) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("k"), _part(1, k).alias("left"), _part(k + 1, size).alias("right")) for k in range(1, size)])

    every = F.when(F.col("w4") != 0, cuts(4)).when(F.col("w3") != 0, cuts(3)).otherwise(cuts(2))
    known = counts.select(F.struct(*[f"w{k}" for k in range(1, ORDER + 1)]).alias("part"), "f")
    rows = candidates.select("w1", "w2", "w3", "w4", F.col("f").alias("a"), F.explode(every).alias("cut"))
    rows = rows.select("w1", "w2", "w3", "w4", "a", "cut.k", "cut.left", "cut.right")
    rows = rows.join(known.select(F.col("part").alias("left"), F.col("f").alias("l")), "left")
    rows = rows.join(known.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr("CAST(CAST(a AS DECIMAL(20, 0)) * 2000000 div (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return rows.groupBy("w1", "w2", "w3", "w4", "a").agg(best).select("w1", "w2", "w3", "w4", "a", "best.l", "best.r", "best.score")


def _in_words(scored: DataFrame, words: DataFrame) -> DataFrame:
    """With the phrase's text and language in place of codes."""
    for k in range(1, ORDER + 1):
        own = words.select(F.col("code").alias(f"w{k}"), F.col("word").alias(f"word{k}"), *([F.col("lang")] if k == 1 else []))
        scored = scored.join(own, f"w{k}", "inner" if k == 1 else "left")
    return scored.select("lang", F.concat_ws(" ", *[f"word{k}" for k in range(1, ORDER + 1)]).alias("phrase"), "a", "l", "r", "score")


def _first(rows: DataFrame, top: int) -> DataFrame:
    """The first `top` of each language, in two steps: of each 64th of the phrases, then of what is left."""
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPLIT))
    some = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    some = some.filter(F.col("rank") <= top).drop("part", "rank")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)


def _ranked_words(words: DataFrame, least: int) -> tuple[DataFrame, Ranks]:
    """The words found `least` times, and the codes."""
    often = words.filter(F.col("f") >= least)
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n"), F.count_if(F.col("f") >= least).alias("often")).first()
    table = most_frequent(often, "f", SENT).toArrow()
    table = table.take(np.lexsort((table["word"].to_numpy(), table["lang"].to_numpy(), -table["f"].to_numpy()))).combine_chunks()
    keys = _word_keys(table["word"].combine_chunks(), table["lang"].combine_chunks()) if table.num_rows else np.empty(0, np.uint64)
    counts = table["f"].to_numpy() if table.num_rows else np.empty(0, np.int64)
    return often, Ranks(keys, counts, total["often"] == table.num_rows, total["n"])


def collocations(docs: DataFrame, *, least: int = 30, percent: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases of 2 to 4 words.

    a: the phrase's count; l, r: of its two parts, where the score floor(2000000 * a / (l + r)) is lowest;
    n: of all words. Phrases inside a longer one with `percent` of their count are not candidates.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    source = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = materialise(word_counts(source), "words")
    often, ranks = _ranked_words(words, least)
    dictionary = materialise(_coded(often, ranks), "dictionary")
    single = dictionary.select(F.col("code").alias("w1"), *[F.lit(0).cast("long").alias(f"w{k}") for k in range(2, ORDER + 1)], "f")
    counts = materialise(single.unionByName(phrase_counts(_window_counts(source, ranks), least)), "phrases")
    phrases = counts.filter("w2 <> 0")
    inside = _within(percent, counts)
    whole = F.struct(*[f"w{k}" for k in range(1, ORDER + 1)])
    same = phrases.withColumn("part", whole).join(inside, "part", "left")
    big = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("f").cast("decimal(20,0)") * percent
    candidates = same.filter(~F.coalesce(big, F.lit(False))).select("w1", "w2", "w3", "w4", "f")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = _first(_in_words(_scored(candidates, counts), dictionary), top)
    return found.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
