"""Samples that models are fitted on, and documents far longer than others."""

from __future__ import annotations

import collections
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import gru, language_id, line_dedup, quality_model
from tidemark.llm.sampling import RANGE, hash_bound


def test_a_hot_doc_id_leaves_every_language_its_rows(spark):
    rows = [(7, f"der kleine Satz Nummer {k} und noch mehr", "de") for k in range(7000)]
    rows += [(7, f"the little sentence number {k} and some more", "en") for k in range(500)]
    rows += [(7, f"la petite phrase avec le {k} et encore plus", "fr") for k in range(500)] + [(8, "una frase sola", "es")]
    rows += [(9, "the same text again", "en")] * 3000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    drawn = language_id.draw(docs, 400).collect()
    assert collections.Counter(r.lang for r in drawn) == {"de": 100, "en": 100, "fr": 100, "es": 1}
    assert len({(r.lang, r.text) for r in drawn}) == len(drawn)
    model = language_id.fit(docs, sample_rows=400)
    said = spark.createDataFrame([(1, "et la petite phrase"), (2, "the little more"), (3, "und noch der Satz")], "doc_id bigint, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.predict(said, model).collect()} == {1: "fr", 2: "en", 3: "de"}


def test_more_languages_than_rows_of_the_sample(spark):
    docs = spark.createDataFrame([(k, f"text {k} of some language", f"l{k % 50:02d}") for k in range(200)], "doc_id bigint, text string, lang string")
    assert {r.lang for r in language_id.draw(docs, 10).collect()} == {f"l{k:02d}" for k in range(50)}
    assert language_id.draw(docs.limit(0), 10).count() == 0


@pytest.mark.parametrize("total", [10**4, 10**7, 10**11, 10**15])
def test_bounds_draw_at_any_size(total):
    assert abs(hash_bound(3000, total) / RANGE * total - 3000) < 1
    assert hash_bound(3000, 3000) == hash_bound(1, 0) == RANGE - 1


def test_one_row_of_each_rated_document(spark):
    labels = [(k, 1, 0) for k in range(4000)] + [(k, 0, 0) for k in range(4000, 4300)] + [(5000, 1, 1)] + [(5001, 1, 0), (5001, 0, 1)] * 500
    labels = spark.createDataFrame([*labels, (None, 1, 0)], "doc_id bigint, quality int, toxic int").repartition(3)
    drawn = quality_model.draw(labels, 500).collect()
    by_grade = collections.Counter(r.grade for r in drawn)
    assert len({r.doc_id for r in drawn}) == len(drawn) < 700
    assert by_grade[2] == 500 * 4000 // 4302 and by_grade[1] == 50 and by_grade[0] == 2
    docs = spark.createDataFrame([(5001, f"bad words {k}") for k in range(3000)] + [(k, f"good words {k}") for k in range(600)], "doc_id bigint, text string")
    model = quality_model.fit(docs, labels, sample_rows=500)
    assert model.able


def test_a_long_document_beside_short_ones():
    rng = np.random.default_rng(3)
    w = gru.Weights.start(np.arange(400, 0, -1).astype(float), 2, 20, 8)
    lengths = np.array([150_000] + [400] * 300)
    ids = rng.integers(0, 400, lengths.sum()).astype(np.int32)
    tracemalloc.start()
    long = gru.score(w, ids, lengths)
    peak = tracemalloc.get_traced_memory()[1]
    gru.Learner(w, 0.1).learn(ids[:60_000], np.array([50_000] + [100] * 100))
    tracemalloc.stop()
    assert peak < 60e6  # four dense arrays of all steps and lanes would take 500 MB
    w = gru.Weights.start(np.arange(400, 0, -1).astype(float), 2, 20, 8)
    alone = gru.score(w, ids[150_000:150_400], np.array([400]))
    assert abs(alone[0] - long[1]) < 1e-3 * abs(alone[0])


def test_every_id_is_learned_from():
    w = gru.Weights.start(np.ones(30), 2, 4, 6)
    lengths = np.array([5, 1, 77, 130, 2])
    ids = np.random.default_rng(1).integers(0, 30, lengths.sum()).astype(np.int32)
    assert gru.Learner(w, 0.1).learn(ids, lengths, lanes=2, window=8) == lengths.sum()


def test_documents_of_many_frequent_lines(spark):
    n = 50_000
    own = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.concat(F.lit("line "), k.cast("string")))
    docs = spark.range(12).select(
        F.col("id").alias("doc_id"), F.array_join(F.concat(own, F.array(F.concat(F.lit("own "), F.col("id"))), F.slice(own, 1, 5)), "\n").alias("text"),
        F.lit("x").alias("__gone"), F.lit("y").alias("__text"), F.lit("z").alias("hash"),
    )
    began = time.perf_counter()
    got = line_dedup.dedup_lines(docs.drop("__gone"), min_docs=10, batches=2).select("doc_id", "text", "n_lines", "n_dropped", "hash").collect()
    assert sorted(tuple(r) for r in got) == [(k, f"own {k}", n + 6, n + 5, "z") for k in range(12)]
    assert time.perf_counter() - began < 90
