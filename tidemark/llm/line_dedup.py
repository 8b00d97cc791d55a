"""Line dedup: levelled sorted runs of line hashes.

A line's key is the line stripped of `[\\x20\\x09-\\x0D]` at both ends, A-Z lower-cased. A key found in at
least `min_docs` documents is frequent; all its lines go, in every document. Which keys are frequent is
kept in runs, as a log-structured index keeps them: a run holds (key hash, number of documents) sorted
by hash; each batch of documents anti-joins the keys already known to be frequent, for those need no
more counting, and adds one run of the rest; `fanout` runs of one level are merged into one of the next.

Defined results: null or empty text is one empty line; the empty key is never frequent; a key counts
once for each row it occurs in, and rows that repeat are documents of their own; a text that loses all
its lines becomes empty; all columns of the input stay, and columns named `n_lines` or `n_dropped` are
replaced. Keys are told apart by 128 bits of hash.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.words import LOWER, SPACE_CHARS, UPPER, let
from tidemark.workspace import Storage, materialise, work_dir


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hash(line: Column) -> Column:
    """128 bits for a line's key; null for the empty key."""
    key = F.btrim(F.translate(line, UPPER, LOWER), F.lit(SPACE_CHARS))
    both = F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))
    return F.when(key != "", both)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, *, batches: int, doc_id: str = "doc_id") -> DataFrame:
    """Stored rows `id`, `hash`, `a`, `b`, `at` for each line with a key: its document, told by doc_id and
    text, the key's hash, and its place. `first` marks one row for each document and key, `part` is
    the batch it came with.

    A document's keys are put in order once, so that equal ones stand together: nothing is compared
    pair by pair, however many lines a document has.
    """
    keyed = F.transform(lines(F.col("text")), lambda x, at: F.struct(line_hash(x).alias("h"), at.alias("at")))
    ordered = F.sort_array(F.transform(F.filter(keyed, lambda x: x["h"].isNotNull()), lambda x: F.struct(x["h"]["a"].alias("a"), x["h"]["b"].alias("b"), x["at"].alias("at"))))

    def marked(rows: Column) -> Column:
        def row(x: Column, k: Column) -> Column:
            before = F.get(rows, k - 1)
            same = F.coalesce((before["a"] == x["a"]) & (before["b"] == x["b"]), F.lit(False))
            return F.struct(x["a"].alias("a"), x["b"].alias("b"), x["at"].alias("at"), (~same).alias("first"))

        return F.transform(rows, row)

    part = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(batches)).cast("int")
    rows = docs.select(
        part.alias("part"), F.col(doc_id).alias("id"), text_hash(F.col("text")).alias("hash"), F.explode(let(ordered, marked)).alias("x")
    ).select("part", "id", "hash", "x.*")
    path = work_dir(docs.sparkSession, "lines")
    rows.write.partitionBy("part").parquet(path)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.sparkSession.read.schema(f"id {kind}, hash bigint, a bigint, b bigint, at int, first boolean, part int").parquet(path)


class LineRuns:
    """The runs of one corpus, below one folder that all executors reach. Which runs count is written after
    each batch as a new list, so a later session goes on where this one stopped, and a run that a dead
    session left unlisted is not read.

    `add` takes the line hashes of a batch, one row for each document and key. `frequent` gives the keys
    found in at least `min_docs` documents of all batches so far.
    """

    def __init__(self, spark: SparkSession, path: str, min_docs: int = 10, fanout: int = 4):
        if min_docs < 1 or fanout < 2:
            raise ValueError("min_docs is at least 1, fanout at least 2")
        self.spark, self.path, self.min_docs, self.fanout = spark, path, min_docs, fanout
        self.levels: list[list[str]] = [[]]
        self.written = self.lists = 0
        self.storage = Storage(spark)
        known = self.storage.matching_paths(f"{path}/list-*.json")
        if known:
            self.levels, self.written = json.loads(self.storage.read_text(known[-1])).values()
            self.lists = int(known[-1].rpartition("-")[2].removesuffix(".json")) + 1

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("a bigint, b bigint, n_docs bigint").parquet(*paths)

    def _write(self, run: DataFrame, level: int) -> None:
        path = f"{self.path}/level={level}/run={self.written}"
        self.written += 1
        run.sortWithinPartitions("a", "b").write.mode("overwrite").parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _merge(self, paths: list[str]) -> DataFrame:
        return self._read(paths).groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"))

    def paths(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def add(self, hashes: DataFrame) -> None:
        own = hashes.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_docs"))
        if self.paths():
            own = own.join(self.frequent(), ["a", "b"], "left_anti")
        self._write(own, 0)
        merged: list[str] = []
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                self.levels[level] = []
                self._write(self._merge(runs), level + 1)
                merged += runs
        listed = json.dumps({"levels": self.levels, "written": self.written})
        self.storage.write_text(f"{self.path}/list-{self.lists:09d}.json", listed)
        self.lists += 1
        for path in merged:  # in no list any more
            self.storage.delete(path)

    def frequent(self) -> DataFrame:
        if not self.paths():
            return self.spark.createDataFrame([], "a bigint, b bigint")
        return self._merge(self.paths()).filter(F.col("n_docs") >= self.min_docs).select("a", "b")


def frequent_lines(hashes: DataFrame, *, min_docs: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """The frequent keys; the stored hashes go through the runs part by part."""
    spark = hashes.sparkSession
    runs = LineRuns(spark, work_dir(spark, "runs"), min_docs, fanout)
    for k in range(batches):
        runs.add(hashes.filter((F.col("part") == k) & F.col("first")).select("a", "b"))
    return materialise(runs.frequent(), "frequent")


def drop_lines(docs: DataFrame, hashes: DataFrame, frequent: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """`docs` without the lines of the frequent keys, and how many there were and went.

    Which lines of a document go is found on stored hashes alone, as places; the texts are moved once,
    to meet them. Rows of equal doc_id and text lose the same lines.
    """
    gone = (
        hashes.select(F.col("id").alias("__id"), F.col("hash").alias("__hash"), "a", "b", "at").join(frequent, ["a", "b"], "left_semi")
        .groupBy("__id", "__hash")
        .agg(F.collect_set("at").alias("__gone"))
    )
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (text_hash(F.col("text")) == F.col("__hash"))
    joined = docs.drop("n_lines", "n_dropped").join(gone, same, "left")
    kept = let(
        lines(F.col("text")),
        lambda every: F.transform(F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("__gone")), lambda at: F.get(every, at)),
    )
    left = joined.withColumn("__kept", F.when(F.col("__gone").isNotNull(), kept))
    out = left.withColumn("n_lines", F.size(lines(F.col("text"))).cast("long"))
    out = out.withColumn("n_dropped", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join("__kept", "\n"))
    return out.withColumn("text", text).drop("__id", "__hash", "__gone", "__kept")


def dedup_lines(docs: DataFrame, *, min_docs: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """`docs` without its frequent lines; see the module for the results in odd cases."""
    hashes = line_hashes(docs, batches=batches)
    return drop_lines(docs, hashes, frequent_lines(hashes, min_docs=min_docs, batches=batches, fanout=fanout))
