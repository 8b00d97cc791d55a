"""From `documents` to token ids, in stages; each one's rows are written and read again as the next one's.

Defined results: empty input gives empty output; documents without a word are rejected by the first stage;
rows with equal doc_id and text are one from the near-duplicate stage on; columns beyond those of
`documents` stay until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import line_dedup, mixing, near_dedup, pieces, quality_model
from tidemark.llm.queries import PIECES_MODEL, source_group
from tidemark.workspace import materialise


BATCH_ROWS = 2_000  # of whole texts that are handed to a Python worker at once
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _bounded_batches(spark: SparkSession) -> None:
    """Batches are counted in rows; those of texts are kept smaller than Spark's own bound for narrow rows."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose chance of the top grade is 0.4 or more: neither toxic nor poor."""
    _bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_model.fit(docs, labels, sample_rows=5000)
    return quality_model.judge(docs, model, threshold=0.4).filter("accepted").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 of the documents go; documents stay, even empty ones. n_chars follows."""
    left = line_dedup.dedup_lines(docs, min_docs=10)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one of the least doc_id. Five words, similarity 0.8."""
    _bounded_batches(spark)
    found = near_dedup.groups(docs, width=5, percent=80)
    first = found.filter("first").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    hashed = docs.withColumn("__text", F.xxhash64("text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & F.col("__text").eqNullSafe(F.col("__hash"))
    return hashed.join(first, same, "left_semi").dropDuplicates(["doc_id", "__text"]).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, even weights on every level of the tree, no document twice."""
    return mixing.mix(docs, domain=source_group(), budget_percent=90, max_epochs=1, seed=17)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each whole document."""
    _bounded_batches(spark)
    encoded = pieces.encode(docs, pieces.Pieces.load(PIECES_MODEL))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality classifier", judge_quality),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_documents),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
