"""Language identification in two steps: the family first, then the languages within it.

A text's features are its byte pairs and byte triples, hashed, A-Z lower-cased, digits and signs taken for
spaces, as damped shares of the whole text. One linear classifier for each family against the rest picks
the family; within it one linear support vector machine for each pair of languages votes, and the margins
settle ties. The models are fitted on a bounded sample of the labelled rows, drawn at one rate for each
language; predictions see the text alone.

Defined results: `und`, with score 0, for null texts and texts without a letter, and for every text if
nothing could be learned; a single language or family is predicted as it is; equal votes and margins go
to the language first in the alphabet; rows that repeat are each predicted; only doc_id is carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.hashing import slices
from tidemark.llm.sampling import hash_bound
from tidemark.llm.ship import ship

# Families of languages by their two-letter codes. Any other language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne", "sa"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt", "am"),
    "sinitic": ("zh", "yue"),
}
PAIRS, TRIPLES = 2048, 6144
SIZE = PAIRS + TRIPLES

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[c for c in range(128) if not (97 <= c <= 122 or 65 <= c <= 90)]] = 32


def family(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of rows of features, each with the number of its first text."""
    for first, end, data, bounds in slices(texts):
        folded = _FOLD[data]
        pairs = folded[:-1] << np.uint32(8) | folded[1:]
        two = (pairs * np.uint32(0x9E3779B1)) >> np.uint32(21)
        three = ((pairs[:-1] << np.uint32(8) | folded[2:]) * np.uint32(0x85EBCA6B) >> np.uint32(8)) % np.uint32(TRIPLES)
        for block in range(0, end - first, 256):
            rows = min(256, end - first - block)
            out = np.zeros((rows, SIZE), np.float32)
            for k in range(rows):
                a, b = bounds[block + k], bounds[block + k + 1]
                if b - a > 1:
                    out[k, :PAIRS] = np.bincount(two[a : b - 1], minlength=PAIRS)
                if b - a > 2:
                    out[k, PAIRS:] = np.bincount(three[a : b - 2], minlength=TRIPLES)
            np.sqrt(out, out=out)
            out /= np.maximum(np.sqrt(np.einsum("ij,ij->i", out, out)), 1e-6)[:, None]
            yield first + block, out


def fit_svm(x: np.ndarray, positive: np.ndarray, *, penalty: float = 1e-4, rounds: int = 120) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, classes weighted alike; accelerated descent."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32)
    w = np.zeros(x.shape[1] + 1, np.float32)
    ahead, before = w.copy(), w.copy()
    rate = 1 / (2 * 2.0 + penalty)  # rows have length 1, and a constant 1 besides
    for k in range(rounds):
        gap = np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1]))
        slope = -2 * share * y * gap
        step = np.append(x.T @ slope + penalty * ahead[:-1], slope.sum())
        w = ahead - rate * step.astype(np.float32)
        ahead = w + (k / (k + 3)) * (w - before)
        before = w
    return w[:-1], float(w[-1])


class Model:
    """families: name to its languages; weights: a column for each family, then for each pair."""

    def __init__(self, x: np.ndarray, languages: list[str]):
        names = np.array(languages, dtype=object)
        known = sorted(set(languages))
        self.families = {f: [g for g in known if family(g) == f] for f in sorted({family(g) for g in known})}
        self.pairs = [p for members in self.families.values() for p in combinations(members, 2)]
        belongs = np.array([family(g) for g in languages], dtype=object)
        columns = []
        for f in self.families:
            columns.append(fit_svm(x, belongs == f) if len(self.families) > 1 else (np.zeros(SIZE, np.float32), 1.0))
        for a, b in self.pairs:
            both = (names == a) | (names == b)
            columns.append(fit_svm(x[both], names[both] == a))
        self.weights = np.stack([c[0] for c in columns], axis=1) if columns else np.zeros((SIZE, 0), np.float32)
        self.biases = np.array([c[1] for c in columns], np.float32)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores. A score is the family's and the language's share, from 0 to 1."""
        if not self.families:
            return ["und"] * len(x), np.zeros(len(x))
        margins = x @ self.weights + self.biases
        first = len(self.families)
        names, scores = np.empty(len(x), object), np.zeros(len(x))
        best = margins[:, :first].argmax(axis=1)
        sure = 1 / (1 + np.exp(-4 * margins[np.arange(len(x)), best].astype(float)))
        for k, members in enumerate(self.families.values()):
            rows = np.flatnonzero(best == k)
            votes, sums = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for column, (a, b) in enumerate(self.pairs, first):
                if a in members:
                    m = margins[rows, column].astype(float)
                    p = 1 / (1 + np.exp(-4 * m))
                    for name, won, share in ((a, m >= 0, p), (b, m < 0, 1 - p)):
                        votes[:, members.index(name)] += won
                        sums[:, members.index(name)] += share
            top = (votes + sums / (1 + len(members))).argmax(axis=1) if len(members) > 1 else np.zeros(len(rows), int)
            names[rows] = np.array(members, dtype=object)[top]
            own = sums[np.arange(len(rows)), top] / (len(members) - 1) if len(members) > 1 else 1.0
            scores[rows] = sure[rows] * own
        return names.tolist(), np.clip(scores, 0, 1)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def draw(labelled: DataFrame, sample_rows: int) -> DataFrame:
    """lang and text of a sample: of each language as many distinct texts as go to it when `sample_rows`
    are shared out evenly, and at least one; all, where there are fewer.

    Texts are drawn by a hash of theirs, so neither a repeated doc_id nor repeated texts fill the
    sample. A first bound on the hash, twice as high as needed by the estimated number of distinct
    texts, leaves few rows of each language to be put in order.
    """
    usable = labelled.filter(has_letter(F.col("text")) & F.col("lang").isNotNull())
    hashed = usable.select("lang", "text", F.xxhash64("text", F.lit("sample")).bitwiseAND(F.lit((1 << 63) - 1)).alias("h"))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    each = max(1, sample_rows // max(1, len(sizes)))
    bound = F.lit(-1).cast("long")
    for r in sizes:
        bound = F.when(F.col("lang") == r["lang"], F.lit(hash_bound(2 * each + 20, r["n"]))).otherwise(bound)
    some = hashed.filter(F.col("h") <= bound).groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return some.withColumn("place", place).filter(F.col("place") <= each).select("lang", "text")


def fit(labelled: DataFrame, *, sample_rows: int = 3000) -> Model:
    """labelled: text, lang. At most `sample_rows` rows are learned from, or one for each language if
    there are more languages than that."""
    ship(labelled.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in features(batch.column("text")):
                rows = [(np.flatnonzero(row).astype(np.uint16).tobytes(), row[row > 0].tobytes()) for row in x]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(first, len(x)), pa.array([a for a, _ in rows], pa.binary()), pa.array([b for _, b in rows], pa.binary())],
                    ["lang", "at", "x"],
                )

    rows = (
        draw(labelled, sample_rows).mapInArrow(packed, "lang string, at binary, x binary")
        .orderBy("lang", "at", "x").collect()
    )
    if not rows:
        return Model(np.zeros((0, SIZE), np.float32), [])
    x = np.zeros((len(rows), SIZE), np.float32)
    for k, r in enumerate(rows):
        x[k, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["x"], np.float32)
    return Model(x, [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score for each row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for _, x in features(batch.column("text")):
                found = model.predict(x)
                names += found[0]
                scores.append(found[1])
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            names = [n if ok else "und" for n, ok in zip(names, lettered, strict=True)]
            score = np.where(lettered, np.concatenate(scores), 0.0) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", has_letter(F.col("text")).alias("lettered")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double"
    )
