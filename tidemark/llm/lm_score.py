"""Scores of whole documents by a gated recurrent language model that is trained here.

Counts of all training words are exact and cover the corpus. The most frequent `VOCABULARY` words, the
document's end and one id for all other words form the network's output, factored into classes. Another
word's chance is that of the other-words id times its smoothed frequency among such words, so that the
score is a whole document's chance over all words, seen and unseen.

Learning: a short start on a bounded sample of documents, on the driver; then each task carries on from
there over all training documents in its part of the table, and the tasks' weights are averaged, in
proportion to what they learned from, by a tree of merges. Every document is read to its end with its
state carried on, and every window changes the weights.

A word is told by 64 bits of hash. The counts of the `SENT` most frequent words go to all tasks; the rest
meet their counts in a join on the word, once for each occurrence.

Defined results: null and empty texts are the end alone; a null doc_id counts as the empty text when the
folds are dealt; with no training documents every chance of a word is that of an unseen one; repeated
rows are documents of their own; other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.gru import Learner, Weights, score
from tidemark.llm.hashing import slices, word_hashes
from tidemark.llm.sampling import RANGE, hash_bound
from tidemark.llm.ship import ship
from tidemark.llm.words import words
from tidemark.workspace import materialise

VOCABULARY, CLASSES, HIDDEN = 4096, 64, 16
SENT = 1 << 17
START_TOKENS = 300_000
RATE = 0.2
BUFFER = 1_500_000  # ids a task holds at once, but for one longer document
SMOOTH = 0.1

Batches = Iterator[pa.RecordBatch]


def _counted(batches: Batches) -> Batches:
    """Word counts of a task's texts; the table is handed on whenever it is large."""
    words, counts, size = [], [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        names, place = np.unique(np.concatenate(words), return_inverse=True)
        return names, np.bincount(place, np.concatenate(counts), minlength=len(names)).astype(np.int64)

    def rows(names: np.ndarray, n: np.ndarray) -> Batches:
        for a in range(0, len(names), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(names[a : a + 100_000].view(np.int64)), pa.array(n[a : a + 100_000])], ["word", "n"])

    for batch in batches:
        for _, _, data, bounds in slices(batch.column("text")):
            found, n = np.unique(word_hashes(data, bounds)[0], return_counts=True)
            words.append(found)
            counts.append(n)
            size += len(found)
            if size > 1_500_000:
                names, n = merged()
                words, counts, size = [names], [n], len(names)
                if size > 750_000:
                    yield from rows(names, n)
                    words, counts, size = [], [], 0
    if words:
        yield from rows(*merged())


class Lookup:
    """The counts sent to all tasks, and the network's id of each word."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, all_tokens: int, all_words: int, documents: int):
        """words, most frequent first. all_*: of words, without ends."""
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.known = min(VOCABULARY, len(words))
        ids = np.minimum(np.arange(len(words)), self.known).astype(np.int32)
        self.ids = ids[order]
        self.other, self.end = self.known, self.known + 1
        self.tokens = all_tokens + documents
        self.distinct = all_words + (documents > 0)
        self.documents = documents
        in_vocabulary = int(counts[: self.known].sum())
        self.other_tokens, self.other_words = all_tokens - in_vocabulary, all_words - self.known
        self.frequencies = np.concatenate([counts[: self.known], [self.other_tokens, documents]]).astype(float)
        self.base_of = math.log10(self.tokens + SMOOTH * (self.distinct + 1))
        self.other_of = math.log10(self.other_tokens + SMOOTH * (self.other_words + 1))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the table, and whether the word is there."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return at, self.words[at] == hashes

    def network_ids(self, at: np.ndarray, there: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, each with its end, and how many each has."""
        lengths = counts + 1
        ids = np.full(int(lengths.sum()), self.end, np.int32)
        words = np.ones(len(ids), bool)
        words[np.cumsum(lengths) - 1] = False
        ids[words] = np.where(there, self.ids[at], self.other) if len(self.words) else self.other
        return ids, lengths


def _learning_ids(batches: Batches, lookup: Lookup) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and lengths of whole documents, about BUFFER ids at a time."""
    ids, lengths, size = [], [], 0
    for batch in batches:
        for _, _, data, bounds in slices(batch.column("text")):
            hashes, counts = word_hashes(data, bounds)
            own, n = lookup.network_ids(*lookup.find(hashes), counts)
            ids.append(own)
            lengths.append(n)
            size += len(own)
            if size >= BUFFER:
                yield np.concatenate(ids), np.concatenate(lengths)
                ids, lengths, size = [], [], 0
    if ids:
        yield np.concatenate(ids), np.concatenate(lengths)


def _started(training: DataFrame, lookup: Lookup) -> Weights:
    """Weights after the start on a sample of distinct whole texts, drawn by their hash, of START_TOKENS
    words at most. It only spares the tasks the first steps: they learn from all texts, these too."""
    weights = Weights.start(lookup.frequencies, 2, CLASSES, HIDDEN)
    sent = training.sparkSession.sparkContext.broadcast(lookup)
    hashed = training.select("text", F.xxhash64("text", F.lit("start")).bitwiseAND(F.lit(RANGE - 1)).alias("h"))
    drawn = hashed.filter(F.col("h") <= hash_bound(2 * START_TOKENS, max(1, lookup.tokens)))
    one = drawn.groupBy("h").agg(F.min("text").alias("text"))
    sized = one.withColumn("n", F.size(words(F.col("text"))) + 1)
    upto = F.sum("n").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chosen = sized.withColumn("upto", upto).filter(F.col("upto") <= START_TOKENS)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for _, _, data, bounds in slices(batch.column("text")):
                hashes, counts = word_hashes(data, bounds)
                ids, lengths = sent.value.network_ids(*sent.value.find(hashes), counts)
                ends = np.cumsum(lengths)
                rows += [ids[e - n : e].tobytes() for e, n in zip(ends, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    rows = sorted(r["ids"] for r in chosen.select("text").mapInArrow(run, "ids binary").collect())
    if rows:
        lengths = np.array([len(r) // 4 for r in rows])
        Learner(weights, RATE).learn(np.frombuffer(b"".join(rows), np.int32), lengths, lanes=64, window=16)
    return weights


def _average(weights: list[np.ndarray], learned: list[int]) -> np.ndarray:
    total = sum(learned)
    return sum(w.astype(np.float64) * (n / total) for w, n in zip(weights, learned, strict=True)).astype(np.float32)


def _merged(batches: Batches) -> Batches:
    """One average of all rows, held as one running sum."""
    total, mean = 0, None
    for batch in batches:
        for n, packed in zip(batch.column("n").to_pylist(), batch.column("weights"), strict=True):
            own = np.frombuffer(packed.as_buffer(), np.float32)
            mean = own if mean is None else _average([mean, own], [total, n])
            total += n
    if mean is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([mean.tobytes()], pa.binary())], ["n", "weights"])


def _trained(training: DataFrame, lookup: Lookup) -> Weights:
    weights = _started(training, lookup)
    sent = training.sparkSession.sparkContext.broadcast((lookup, weights))

    def run(batches: Batches) -> Batches:
        lookup, first = sent.value
        learner = Learner(first.unpack(first.pack()), RATE / 2)
        learned = sum(learner.learn(ids, n) for ids, n in _learning_ids(batches, lookup))
        if learned:
            yield pa.RecordBatch.from_arrays([pa.array([learned]), pa.array([learner.w.pack().tobytes()], pa.binary())], ["n", "weights"])

    shape = "n bigint, weights binary"
    parts = training.select("text").mapInArrow(run, shape)
    count = parts.rdd.getNumPartitions()
    while count > 8:  # eight sets of weights at a time
        count = math.ceil(count / 8)
        parts = parts.repartition(count).mapInArrow(_merged, shape)
    rows = parts.collect()  # at most eight
    if not rows:
        return weights
    return weights.unpack(_average([np.frombuffer(r["weights"], np.float32) for r in rows], [r["n"] for r in rows]))


def _scored(sent) -> Callable[[Batches], Batches]:
    def rows(names: list, parts: list, lookup: Lookup, weights: Weights) -> pa.RecordBatch:
        at, there, counts, hashes = (np.concatenate(c) for c in zip(*parts, strict=True))
        ids, lengths = lookup.network_ids(at, there, counts)
        log10 = score(weights, ids, lengths) / math.log(10)
        doc = np.repeat(np.arange(len(counts)), counts)
        c = lookup.counts[at] if len(lookup.words) else np.zeros(len(at))
        logs = np.log10(c + SMOOTH)
        base = np.bincount(doc[there], logs[there] - lookup.base_of, minlength=len(counts))
        base += math.log10(lookup.documents + SMOOTH) - lookup.base_of
        other = there & (lookup.ids[at] == lookup.other) if len(lookup.words) else there
        log10 += np.bincount(doc[other], logs[other] - lookup.other_of, minlength=len(counts))
        known = np.bincount(doc[there], minlength=len(counts)) + (lookup.documents > 0)
        rest = np.bincount(doc[~there], minlength=len(counts))
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(rest)]).astype(np.int32), pa.array(hashes[~there].view(np.int64)))
        return pa.RecordBatch.from_arrays(
            [*(pa.concat_arrays(c) for c in zip(*names, strict=True)), pa.array(lengths), pa.array(known), pa.array(base), pa.array(log10), lists],
            ["doc_id", "held_out", "n_tokens", "known", "base", "log10", "rest"],
        )

    def run(batches: Batches) -> Batches:
        lookup, weights = sent.value
        names, parts, size = [], [], 0
        for batch in batches:
            for first, end, data, bounds in slices(batch.column("text")):
                hashes, counts = word_hashes(data, bounds)
                parts.append((*lookup.find(hashes), counts, hashes))
                names.append([batch.column(c).slice(first, end - first) for c in ("doc_id", "held_out")])
                size += len(hashes) + len(counts)
                if size >= BUFFER:
                    yield rows(names, parts, lookup, weights)
                    names, parts, size = [], [], 0
        if parts:
            yield rows(names, parts, lookup, weights)

    return run


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, log10, of each row."""
    spark = docs.sparkSession
    ship(spark)
    training = docs.filter(~held_out).select("doc_id", "text")
    counts = materialise(
        training.select("text").mapInArrow(_counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "counts"
    )
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("words")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(SENT).collect()
    lookup = Lookup(
        np.array([r["word"] for r in top], np.int64).view(np.uint64), np.array([r["n"] for r in top], np.int64),
        total["n"], total["words"], training.count(),
    )
    sent = spark.sparkContext.broadcast((lookup, _trained(training, lookup)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = materialise(
        docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
            _scored(sent), f"doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, log10 double, rest array<bigint>"
        ).withColumn("uid", F.monotonically_increasing_id()),
        "scores",
    )
    c = F.coalesce(F.col("n"), F.lit(0))
    rare = (
        parts.select("uid", F.explode("rest").alias("word")).join(counts, "word", "left")
        .groupBy("uid").agg(
            F.count(F.lit(1)).alias("rest_tokens"), F.sum((c > 0).cast("long")).alias("rest_known"),
            F.sum(F.log10(c + SMOOTH)).alias("rest_logs"),
        )
    )
    zero = {n: F.coalesce(F.col(n), F.lit(0)) for n in ("rest_tokens", "rest_known", "rest_logs")}
    return parts.drop("rest").join(rare, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero["rest_known"]).alias("n_known"),
        F.lit(lookup.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero["rest_logs"] - zero["rest_tokens"] * lookup.base_of).alias("base_score"),
        (F.col("log10") + zero["rest_logs"] - zero["rest_tokens"] * lookup.other_of).alias("score"),
    )
