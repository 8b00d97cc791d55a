"""The incremental extracts as streams that drain their source."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.common import CHANGES_SQL, Registry, change_log, load
from registered.changes import COLUMNS, REPLAY_SQL
from tidemark.operators.changes import replay, with_seq
from tidemark.plans.backup import run_backup
from tidemark.plans.restore import restore_table
from tidemark.sinks.formats import write_artifact
from tidemark.streaming.increments import (
    file_stream,
    read_extracted,
    read_unique,
    stream_changes,
    stream_extract,
    stream_sets,
)
from tidemark.sources.tables import Table
from tidemark.workspace import work_dir

R = Registry()


@R.add("SELECT * FROM events")
def stream_incremental(spark, sf_dir):
    """Two runs from one checkpoint: the second finds nothing new."""
    schema = load(spark, sf_dir, "events").schema
    out, checkpoint = work_dir(spark, "stream-out"), work_dir(spark, "stream-checkpoint")
    for _ in range(2):
        stream_extract(file_stream(spark, sf_dir, schema, glob="events.parquet"), [out], checkpoint)
    return read_extracted(spark, out, schema).select(schema.names)


@R.add("SELECT * FROM events")
def stream_dedup(spark, sf_dir):
    """Every event arrives twice, newest first, over many batches, and is kept once."""
    events = load(spark, sf_dir, "events")
    source, out = work_dir(spark, "dedup-source"), work_dir(spark, "dedup-out")
    checkpoint = work_dir(spark, "dedup-checkpoint")
    for _ in range(2):
        events.repartitionByRange(3, F.desc("ts")).write.mode("append").parquet(source)
        stream_extract(file_stream(spark, source, events.schema, max_files=1), [out], checkpoint)
    return read_unique(spark, out, events.schema, ["event_id"])


@R.add(CHANGES_SQL)
def stream_change_log(spark, sf_dir):
    """A stored change log followed file by file, in several batches."""
    log = with_seq(change_log(load(spark, sf_dir, "events"))).select(COLUMNS)
    stored, out = work_dir(spark, "stream-log"), work_dir(spark, "stream-log-out")
    write_artifact(log.repartitionByRange("seq", "pos"), stored)
    stream = file_stream(spark, stored, log.schema, glob="*.parquet", max_files=4)
    stream_changes(stream, [out], work_dir(spark, "stream-log-checkpoint"))
    return read_extracted(spark, out, log.schema).select(COLUMNS)


@R.add("""
    SELECT * REPLACE (CASE WHEN event_id % 5 = 0 THEN value + 1 ELSE value END AS value) FROM events
""")
def stream_set_chain(spark, sf_dir):
    """A full set of the older events, then a stream of changed and new ones as sets of their own, restored."""
    base, source = work_dir(spark, "stream-sets"), work_dir(spark, "stream-sets-in")
    events = load(spark, sf_dir, "events").withColumn("version", F.lit(1))
    last = events.agg(F.max("event_id")).first()[0]
    run_backup(
        spark, [Table("app", "events", events.filter(F.col("event_id") <= last // 2))], database="app",
        destinations={"local": base}, at="2024-03-01",
    )
    changed = events.filter("event_id % 5 = 0").withColumns({"value": F.col("value") + 1, "version": F.lit(2)})
    arrived = changed.unionByName(events.filter(F.col("event_id") > last // 2))
    # Both versions of an event arrive together: a batch keeps the last one of each.
    arrived.repartitionByRange(6, "event_id").write.parquet(source)
    stream_sets(
        file_stream(spark, source, arrived.schema, max_files=2), work_dir(spark, "stream-sets-checkpoint"), database="app",
        schema_name="app", table_name="events", destinations={"local": base}, keys=["event_id"], order=["version"],
    )
    back = restore_table(spark, base, "app", "app", "events", ["event_id"], until="2999-01-01")
    return back.drop("version")


@R.add(f"SELECT user_id, event_id, event_type, value FROM ({REPLAY_SQL})")
def stream_log_chain(spark, sf_dir):
    """A full set in the middle of a change log, the rest of it as a stream of sets, and the restored table."""
    base, source = work_dir(spark, "log-sets"), work_dir(spark, "log-sets-in")
    log = with_seq(change_log(load(spark, sf_dir, "events")))
    last = log.agg(F.max("event_id")).first()[0]
    seen = log.filter(F.col("event_id") <= last // 3)
    users = replay(seen, ["user_id"]).select("user_id", "event_id", "event_type", "value")
    run_backup(
        spark, [Table("app", "users", users)], database="app", driver="mysql", at="2024-03-01",
        destinations={"local": base}, changes=[Table("app", "users", seen)],
    )
    # The log arrives in its order; each part overlaps the one before.
    checkpoint, bounds = work_dir(spark, "log-sets-checkpoint"), [last // 3, last // 2, 2 * last // 3, last]
    for low, high in zip(bounds, bounds[1:]):
        part = log.filter(F.col("event_id").between(low - 100, high))
        part.repartitionByRange(2, "seq", "pos").write.mode("append").parquet(source)
        stream_sets(
            file_stream(spark, source, log.schema), checkpoint, database="app", schema_name="app", table_name="users",
            destinations={"local": base}, driver="mysql", log=True,
        )
    return restore_table(spark, base, "app", "app", "users", ["user_id"], driver="mysql", until="2999-01-01")
