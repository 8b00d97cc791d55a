"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's grade is 0 (toxic), 1 (poor) or 2 (good). One vector of weights over hashed features of the
text gives a document's place on a line; ordered thresholds cut the line into grades, and the logistic
distribution gives the probability to lie beyond each. From these come the expected grade and the tail
probability of the top grade, which selects.

Features, of the whole text: which of the telling words occur, by hash, with letters only and A-Z
lower-cased; byte pairs as they stand, hashed, as damped shares; how much the words repeat, in bins.
Telling words are those whose occurrence depends on the grade in the sample, by a chi-squared test. A
word weighs the same in a long text as in a short one, unlike a share.

Defined results: null texts and texts without a letter get grade 0, tail 0 and are rejected; with fewer than
two grades to learn from every other document is kept; labels that are null, or without a document,
are not learned from; of several labels of one doc_id each counts; rows that repeat are each judged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tidemark.llm.hashing import slices, word_hashes
from tidemark.llm.sampling import hash_bound
from tidemark.llm.ship import ship

PAIRS, BINS = 4096, 12
GRADES = 3
HELD, TELLING = 6, 24.0  # a telling word is in so many documents of the sample at least, with this chi-squared

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def grade(quality: Column, toxic: Column) -> Column:
    """Null unless both are known."""
    return F.when(quality.isNull() | toxic.isNull(), None).when(toxic > 0, 0).when(quality > 0, 2).otherwise(1)


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the hashes of its distinct words, and its shares of byte pairs with the bin of repetition."""
    for first, end, data, bounds in slices(texts):
        words, counts = word_hashes(_LETTERS[data], bounds)
        at = np.concatenate([[0], np.cumsum(counts)])
        wide = data.astype(np.uint32)
        pairs = ((wide[:-1] << np.uint32(8) | wide[1:]) * np.uint32(0x9E3779B1)) >> np.uint32(20)
        for k in range(end - first):
            a, b = bounds[k], bounds[k + 1]
            shares = np.zeros(PAIRS + BINS, np.float32)
            if b - a > 1:
                found = np.sqrt(np.bincount(pairs[a : b - 1], minlength=PAIRS).astype(np.float32))
                shares[:PAIRS] = 3 * found / np.sqrt((found**2).sum())
            distinct = np.unique(words[at[k] : at[k + 1]])
            if counts[k]:
                # Long texts repeat words by nature: a power of the length stands for what is expected.
                shares[PAIRS + min(BINS - 1, int(6 * len(distinct) / counts[k] ** 0.9))] = 1
            yield distinct, shares


def telling_words(found: list[np.ndarray], grades: np.ndarray) -> np.ndarray:
    """Hashes, sorted, of the words whose occurrence in a document depends on its grade."""
    sizes = np.array([len(f) for f in found])
    names, place = np.unique(np.concatenate(found), return_inverse=True)
    by_grade = np.stack([np.bincount(place, np.repeat(grades == g, sizes).astype(float), minlength=len(names)) for g in range(GRADES)], axis=1)
    share = np.bincount(grades, minlength=GRADES) / len(grades)
    held = by_grade.sum(axis=1, keepdims=True)
    expected = held * share
    gap = (by_grade - expected) ** 2
    absent = np.maximum(len(grades) * share - expected, 1e-9)
    chi = (gap / np.maximum(expected, 1e-9) + gap / absent)[:, share > 0].sum(axis=1)
    return names[(held[:, 0] >= HELD) & (chi >= TELLING)]


class Model:
    """Cumulative link: the chance of a grade above g is logistic(place - cuts[g])."""

    def __init__(self, found: list[np.ndarray], shares: np.ndarray, grades: np.ndarray, *, rounds: int = 400, penalty: float = 3e-4):
        self.names, self.words = np.zeros(0, np.uint64), np.zeros(0)
        self.pairs, self.cuts = np.zeros(PAIRS + BINS, np.float32), np.array([-1.0, 1.0])
        self.able = len(set(grades.tolist())) > 1
        if not self.able:
            return
        n = len(found)
        self.names = telling_words(found, grades)
        hits = [np.flatnonzero(np.isin(self.names, f, assume_unique=True)) for f in found]
        rows, flat = np.repeat(np.arange(n), [len(h) for h in hits]), np.concatenate(hits)
        count = len(self.names)
        share = np.bincount(grades, minlength=GRADES).astype(float)
        weight = (1 / np.sqrt(np.maximum(share, 1)))[grades]
        weight /= weight.sum()
        words, pairs, cuts = np.zeros(count), np.zeros(PAIRS + BINS), np.array([-1.0, 1.0])
        sums = [np.zeros(count), np.zeros(PAIRS + BINS), np.zeros(2)]
        for _ in range(rounds):
            place = np.bincount(rows, words[flat], minlength=n) + shares @ pairs.astype(np.float32)
            p = [1 / (1 + np.exp(-(place - c))) for c in cuts]
            chance = np.stack([1 - p[0], p[0] - p[1], p[1]]).clip(1e-9)[grades, np.arange(n)]
            d = [q * (1 - q) for q in p]  # slopes of the two logistic curves
            lowest, middle = grades == 0, grades == 1
            slope = np.select([lowest, middle], [-d[0], d[0] - d[1]], d[1]) / chance * weight
            in_cuts = [
                np.select([lowest, middle], [d[0], -d[0]], 0.0) / chance * weight,
                np.select([lowest, middle], [0.0, d[1]], -d[1]) / chance * weight,
            ]
            steps = (
                np.bincount(flat, slope[rows], minlength=count) - penalty * words,
                shares.T @ slope.astype(np.float32) - penalty * pairs,
                np.array([g.sum() for g in in_cuts]),
            )
            for total, target, step in zip(sums, (words, pairs, cuts), steps, strict=True):
                total += step**2
                target += 0.3 * step / (np.sqrt(total) + 1e-8)
            cuts[1] = max(cuts[1], cuts[0] + 0.1)  # ordered
        self.words, self.pairs, self.cuts = words, pairs.astype(np.float32), cuts

    def place(self, found: np.ndarray, shares: np.ndarray) -> float:
        if not len(self.names):
            return float(shares @ self.pairs)
        at = np.searchsorted(self.names, found).clip(max=len(self.names) - 1)
        return float(self.words[at[self.names[at] == found]].sum() + shares @ self.pairs)


def draw(labels: DataFrame, sample_rows: int) -> DataFrame:
    """doc_id and grade of a sample of at most about `sample_rows` labelled documents: each grade has its
    share of them, and at least a tenth of `sample_rows` where it has so many. A document that was
    rated several times counts once, with its least grade.
    """
    rated = labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade")).filter("grade IS NOT NULL AND doc_id IS NOT NULL")
    single = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    hashed = single.withColumn("h", F.xxhash64(F.col("doc_id"), F.lit("sample")).bitwiseAND(F.lit((1 << 63) - 1)))
    sizes = {r["grade"]: r["count"] for r in hashed.groupBy("grade").count().collect()}
    total = max(1, sum(sizes.values()))
    wanted = {g: max(sample_rows * n // total, min(n, sample_rows // 10)) for g, n in sizes.items()}
    bound, most = F.lit(-1).cast("long"), F.lit(0)
    for g, n in sizes.items():
        bound = F.when(F.col("grade") == g, F.lit(hash_bound(2 * wanted[g] + 20, n))).otherwise(bound)
        most = F.when(F.col("grade") == g, F.lit(wanted[g])).otherwise(most)
    place = F.row_number().over(Window.partitionBy("grade").orderBy("h", "doc_id"))
    some = hashed.filter(F.col("h") <= bound).withColumn("place", place)
    return some.filter(F.col("place") <= most).select("doc_id", "grade")


def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 5000) -> Model:
    """At most about `sample_rows` labelled documents are learned from; of rows of one doc_id, one."""
    ship(docs.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, at, share = [], [], []
            for found, shares in features(batch.column("text")):
                words.append(found.tobytes())
                at.append(np.flatnonzero(shares).astype(np.uint16).tobytes())
                share.append(shares[shares > 0].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), *(pa.array(c, pa.binary()) for c in (words, at, share))],
                ["doc_id", "grade", "words", "at", "share"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    # At most 1.3 * sample_rows rows of two numbers go to all tasks.
    joined = docs.select("doc_id", "text").join(F.broadcast(draw(labels, sample_rows)), "doc_id")
    one = joined.groupBy("doc_id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = one.select("doc_id", "grade", "text").mapInArrow(packed, f"doc_id {kind}, grade int, words binary, at binary, share binary").orderBy("doc_id", "grade", "words").collect()
    shares = np.zeros((len(rows), PAIRS + BINS), np.float32)
    for k, r in enumerate(rows):
        shares[k, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["share"], np.float32)
    return Model([np.frombuffer(r["words"], np.uint64) for r in rows], shares, np.array([r["grade"] for r in rows], int))


def judge(docs: DataFrame, model: Model, *, threshold: float = 0.5) -> DataFrame:
    """All columns and `expected_grade`, `p_acceptable` (above 0), `p_good` (the tail of the top grade), `accepted`."""
    spark = docs.sparkSession
    ship(spark)
    new = {"expected_grade": "double", "p_acceptable": "double", "p_good": "double", "accepted": "boolean"}
    kept = [f for f in docs.schema.fields if f.name.lower() not in new]
    base = docs.select(*[F.col(f"`{f.name}`") for f in kept])
    sent = spark.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            place, some = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            for k, (found, shares) in enumerate(features(batch.column("text"))):
                some[k] = len(found) > 0
                place[k] = model.place(found, shares)
            p = [np.where(some, 1 / (1 + np.exp(-(place - c))) if model.able else 1.0, 0.0) for c in model.cuts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p[0] + p[1]), pa.array(p[0]), pa.array(p[1]), pa.array(some & (p[1] >= threshold))],
                [*batch.schema.names, *new],
            )

    schema = T.StructType(kept + [T.StructField(n, T.DoubleType() if k == "double" else T.BooleanType()) for n, k in new.items()])
    return base.mapInArrow(run, schema)
