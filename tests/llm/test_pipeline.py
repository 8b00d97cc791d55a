"""The pipeline, stage by stage, against what each stage has to do with its own input."""

from __future__ import annotations

import collections

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline


def line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute_groups(texts, width):
    """The least id that each text reaches over pairs of similarity 0.8."""
    sets, by_member = {}, collections.defaultdict(list)
    label = {k: k for k in texts}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for k in sorted(texts):
        w = (texts[k] or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
        shared = collections.Counter(j for m in sets[k] for j in by_member[m])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[k]) + len(sets[j]) - n):
                a, b = root(k), root(j)
                label[max(a, b)] = min(a, b)
        for m in sets[k]:
            by_member[m].append(k)
    return {k: root(k) for k in texts}




def test_stages(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    columns, inputs = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = corpus_pipeline.materialise(stage(spark, docs, medium), "test")
        assert name == "sentencepiece" or docs.columns == columns
    source, judged, lined, single, mixed = [{r.doc_id: r for r in d.collect()} for d in inputs]
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    good = [k in judged for k, v in labels.items() if v == (1, 0)]
    toxic = [k in judged for k, v in labels.items() if v[1]]
    assert sum(good) > 0.97 * len(good) and sum(toxic) < 0.1 * len(toxic)
    assert all(judged[k] == source[k] for k in judged)
    # Lines
    found = collections.Counter(k for r in judged.values() for k in {line_key(x) for x in r.text.split("\n")} if k)
    for k, r in judged.items():
        lines = r.text.split("\n")
        kept = [x for x in lines if found[line_key(x)] < 10]
        assert lined[k].text == "\n".join(kept) and lined[k].n_chars == (len(lined[k].text) if len(kept) < len(lines) else r.n_chars)
    # One of each group
    groups = brute_groups({k: r.text for k, r in lined.items()}, 5)
    assert set(single) == {k for k, g in groups.items() if k == g}
    assert set(mixed) <= set(single) and len(mixed) > 0.8 * len(single)
    # Ids
    ids = {r.doc_id: r for r in docs.collect()}
    assert ids.keys() == mixed.keys()
    model = corpus_pipeline.pieces.Pieces.load(corpus_pipeline.PIECES_MODEL)
    packed = model.encode([mixed[k].text for k in ids])
    assert all(np.frombuffer(p, np.int32).tolist() == r.ids and r.n_pieces == len(r.ids) for p, r in zip(packed, ids.values(), strict=True))


def test_odd_documents(spark, medium):
    rows = [(k, t, None, None, None, "x") for k, t in enumerate([None, "", " ", "some words", "some words", "a\n" * 3000])] + [(3, "some words", None, None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, accepted string")
    single = corpus_pipeline.dedup_documents(spark, docs, medium)
    assert sorted(r.doc_id for r in single.collect()) == [0, 1, 2, 3, 5]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), medium).count() == 0
        stage(spark, docs, medium).write.format("noop").mode("overwrite").save()
    assert corpus_pipeline.mix_sources(spark, docs.filter(F.col("doc_id") > 2), medium).columns == docs.columns
