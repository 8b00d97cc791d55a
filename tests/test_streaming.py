"""Streams that resume from their checkpoint."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from registered.common import change_log, load
from tidemark.operators.changes import declare_seq, with_seq
from tidemark.plans.backup import run_backup
from tidemark.plans.restore import restore_table
from tidemark.plans.retention import apply_retention
from tidemark.sources.manifests import manifest_artifacts, read_manifests
from tidemark.sources.tables import Table
from tidemark.streaming import increments
from tidemark.streaming.increments import (
    file_stream,
    read_extracted,
    read_unique,
    stream_changes,
    stream_extract,
    stream_sets,
)
from tidemark.workspace import Storage, work_dir


@pytest.fixture
def places(spark):
    root = work_dir(spark, "stream")
    return f"{root}/in", f"{root}/out", f"{root}/copy", f"{root}/checkpoint"


def test_runs_take_up_where_the_last_one_stopped(spark, small, places):
    source, out, copy, checkpoint = places
    events = load(spark, small, "events")
    seen = []
    for low, high in ((0, 400), (400, 1000), (1000, 1000)):
        events.filter(F.col("event_id").between(low, high - 1)).write.mode("append").parquet(source)
        stream_extract(file_stream(spark, source, events.schema), [out, copy], checkpoint)
        seen.append(read_extracted(spark, out, events.schema).count())
    assert seen == [400, 1000, 1000]
    for place in (out, copy):
        rows = read_extracted(spark, place, events.schema).select(events.columns)
        assert rows.exceptAll(events).isEmpty() and events.exceptAll(rows).isEmpty()


def test_a_failed_batch_is_repeated_and_not_doubled(spark, small, places, monkeypatch):
    source, out, copy, checkpoint = places
    events = load(spark, small, "events")
    events.write.parquet(source)
    real = increments.copy_artifact
    monkeypatch.setattr(increments, "copy_artifact", lambda *a, **k: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        stream_extract(file_stream(spark, source, events.schema), [out, copy], checkpoint)
    monkeypatch.setattr(increments, "copy_artifact", real)
    stream_extract(file_stream(spark, source, events.schema), [out, copy], checkpoint)
    for place in (out, copy):
        assert read_extracted(spark, place, events.schema).count() == events.count()


def test_late_rows_are_kept_and_repeats_folded(spark, small, places):
    source, out, _, checkpoint = places
    events = load(spark, small, "events").filter("event_id < 500")
    for part in (1, 0, 1):  # newest first, then a repeat
        events.filter(F.expr(f"event_id div 250 = {part}")).write.mode("append").parquet(source)
        stream_extract(file_stream(spark, source, events.schema), [out], checkpoint)
    assert read_extracted(spark, out, events.schema).count() == 750
    unique = read_unique(spark, out, events.schema, ["event_id"])
    assert unique.exceptAll(events).isEmpty() and unique.count() == 500


def test_change_log_batches(spark, small, places):
    source, out, _, checkpoint = places
    log = with_seq(change_log(load(spark, small, "events"))).withColumn("seq", F.expr("pos div 10000"))
    log = declare_seq(log)
    log.repartitionByRange(6, "seq").write.parquet(source)
    stream_changes(file_stream(spark, source, log.schema, max_files=2), [out], checkpoint)
    rows = read_extracted(spark, out, log.schema)
    assert rows.select("batch").distinct().count() == 3
    back = rows.select(log.columns)
    assert back.exceptAll(log).isEmpty() and log.exceptAll(back).isEmpty()
    assert "batch=0" in Storage(spark).child_names(out)


def sets_of(spark, source, base, checkpoint, schema, **options):
    stream_sets(
        file_stream(spark, source, schema, max_files=1), checkpoint, database="app", schema_name="app", table_name="t",
        destinations={"a": base, "b": f"{base}/copy"}, **options,
    )


def test_stream_sets_are_sets_like_others(spark, places):
    source, base, _, checkpoint = places
    rows = spark.range(20).select("id", F.lit(1).alias("version"), F.lit("old").alias("v"))
    run_backup(spark, [Table("app", "t", rows)], database="app", destinations={"a": base, "b": f"{base}/copy"}, at="2024-01-01")
    want = {k: "old" for k in range(20)}
    for n in range(3):
        part = spark.range(5 * n, 5 * n + 12).select("id", F.lit(n + 2).alias("version"), F.lit(f"new{n}").alias("v"))
        repeat = part.withColumns({"version": F.lit(0), "v": F.lit("stale")})
        part.unionByName(repeat).coalesce(1).write.mode("append").parquet(source)
        want |= {k: f"new{n}" for k in range(5 * n, 5 * n + 12)}
        sets_of(spark, source, base, checkpoint, rows.schema, keys=["id"], order=["version"])
    for place in (base, f"{base}/copy"):
        back = restore_table(spark, place, "app", "app", "t", ["id"], until="2999-01-01")
        assert {r.id: r.v for r in back.collect()} == want
    listed = read_manifests(spark, base, "a", database="app", driver="pgsql", mode="incremental")
    assert listed.count() == 3 and manifest_artifacts(listed).count() == 3
    plan = apply_retention(spark, {"a": base}, keep=1, database="app", mode="incremental", dry_run=False)
    assert plan.filter("step = 1").count() == 2
    assert read_manifests(spark, base, database="app", driver="pgsql", mode="incremental").count() == 1


@pytest.mark.parametrize("step", ["copy_artifact", "write_manifest"])
def test_a_batch_is_one_set_however_often_it_is_tried(spark, places, monkeypatch, step):
    source, base, _, checkpoint = places
    rows = spark.range(10).select("id", F.lit("v").alias("v"))
    run_backup(spark, [Table("app", "t", rows.limit(0))], database="app", destinations={"a": base, "b": f"{base}/copy"}, at="2024-01-01")
    rows.coalesce(1).write.parquet(source)
    real, calls = getattr(increments, step), []

    def failing(*args, **options):
        calls.append(args)
        if len(calls) <= 2:  # nothing is written at the first destination, then nothing at the second
            raise RuntimeError("lost")
        if step == "write_manifest" and len(calls) == 4:
            raise RuntimeError("lost")
        return real(*args, **options)

    monkeypatch.setattr(increments, step, failing)
    for tries in range(4):
        try:
            sets_of(spark, source, base, checkpoint, rows.schema)
        except Exception as error:
            assert "lost" in str(error)
            if len(calls) <= 2:  # an uncommitted batch is not read
                assert restore_table(spark, base, "app", "app", "t", ["id"], until="2999-01-01").isEmpty()
    for place in (base, f"{base}/copy"):
        assert read_manifests(spark, place, database="app", driver="pgsql", mode="incremental").count() == 1
        assert restore_table(spark, place, "app", "app", "t", ["id"], until="2999-01-01").count() == 10


def test_empty_batches_leave_no_gap(spark, places):
    source, base, _, checkpoint = places
    rows = spark.range(4).select("id", F.lit("v").alias("v"))
    run_backup(spark, [Table("app", "t", rows)], database="app", destinations={"a": base, "b": f"{base}/copy"}, at="2024-01-01")
    for part in (rows, rows.limit(0), rows.limit(0), rows.withColumn("v", F.lit("w"))):
        part.coalesce(1).write.mode("append").parquet(source)
        sets_of(spark, source, base, checkpoint, rows.schema, since="2024-01-01")
    back = restore_table(spark, base, "app", "app", "t", ["id"], until="2999-01-01")
    assert {r.v for r in back.collect()} == {"w"}
