"""Change logs: inventory, slices, gaps, replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.common import CHANGES_SQL, Registry, change_log, load
from tidemark.functions.coordinates import Coordinate
from tidemark.operators.changes import (
    log_end_row,
    log_end,
    log_gaps,
    log_inventory,
    log_slice,
    ordered_slice,
    replay,
    with_seq,
)
from tidemark.operators.restore import apply_changes
from tidemark.sinks.formats import read_artifact, write_artifact
from tidemark.workspace import work_dir

R = Registry()
COLUMNS = ["file", "seq", "pos", "op", "user_id", "event_id", "event_type", "value"]
SLICE_SQL = f"""
    SELECT * FROM ({CHANGES_SQL})
    WHERE (seq > 9 OR seq = 9 AND pos >= 50004) AND (seq < 12 OR seq = 12 AND pos < 30004)
"""
START, END = Coordinate("mysql-bin.9", 50004), Coordinate("mysql-bin.12", 30004)


@R.add(f"""
    SELECT file, seq, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS n_events
    FROM ({CHANGES_SQL}) GROUP BY file, seq
""")
def change_inventory(spark, sf_dir):
    return log_inventory(change_log(load(spark, sf_dir, "events")))


@R.add(f"SELECT file, seq, pos FROM ({CHANGES_SQL}) ORDER BY seq DESC, pos DESC LIMIT 1")
def change_end(spark, sf_dir):
    """The last coordinate of the log, by natural order of the file names."""
    return log_end_row(change_log(load(spark, sf_dir, "events")))


@R.add(SLICE_SQL)
def change_slice(spark, sf_dir):
    """From inside file 9 into file 12: the range runs over the 9 to 10 boundary."""
    return log_slice(change_log(load(spark, sf_dir, "events")), START, END).select(COLUMNS)


@R.add(f"SELECT * FROM ({CHANGES_SQL}) WHERE seq = 9 AND pos >= 20004 AND pos < 80004")
def change_slice_one_file(spark, sf_dir):
    log = change_log(load(spark, sf_dir, "events"))
    start, end = Coordinate("mysql-bin.9", 20004), Coordinate("mysql-bin.9", 80004)
    return log_slice(log, start, end).select(COLUMNS)


@R.add(SLICE_SQL)
def change_slice_stored(spark, sf_dir):
    """The log stored by file, sliced out of that store, and the slice stored and read in turn."""
    log = with_seq(change_log(load(spark, sf_dir, "events"))).select(COLUMNS)
    stored, sliced = work_dir(spark, "log"), work_dir(spark, "slice")
    write_artifact(ordered_slice(log, cluster=True), stored, partition_by=("seq",))
    events = log_slice(read_artifact(spark, stored, log.schema), START, END)
    write_artifact(ordered_slice(events), sliced, partition_by=("seq",))
    return read_artifact(spark, sliced, log.schema).select(COLUMNS)


@R.add(f"""
    SELECT s.seq FROM (SELECT unnest(generate_series(
               (SELECT min(seq) - 1 FROM ({CHANGES_SQL})), (SELECT max(seq) FROM ({CHANGES_SQL})))) AS seq) s
    WHERE s.seq NOT IN (SELECT seq FROM ({CHANGES_SQL}) WHERE seq % 4 <> 1)
""")
def change_gaps(spark, sf_dir):
    """Every fourth file lost, and a start before the first file kept: all are reported."""
    log = with_seq(change_log(load(spark, sf_dir, "events")))
    bounds = log.agg(F.min("seq").alias("first"), F.max("seq").alias("last")).first()
    return log_gaps(log.filter(F.col("seq") % 4 != 1), bounds.first - 1, bounds.last)


REPLAY_SQL = f"""
    SELECT user_id, event_id, event_type, value, seq, pos FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC, pos DESC) AS rn
        FROM ({CHANGES_SQL})) WHERE rn = 1 AND op <> 'delete'
"""


@R.add(REPLAY_SQL)
def change_apply(spark, sf_dir):
    """The last state of every user after replaying the log, deleted users gone."""
    log = with_seq(change_log(load(spark, sf_dir, "events")))
    alive = replay(log, ["user_id"])
    return alive.select("user_id", "event_id", "event_type", "value", "seq", "pos")


@R.add(f"SELECT user_id, event_id, event_type, value FROM ({REPLAY_SQL})")
def change_apply_to_base(spark, sf_dir):
    """A base as of the middle of the log, then the rest of the log applied to it."""
    log = with_seq(change_log(load(spark, sf_dir, "events")))
    middle, end = Coordinate("mysql-bin.11", 70004), log_end(log)
    base = replay(log_slice(log, Coordinate("mysql-bin.8", 4), middle), ["user_id"])
    base = base.select("user_id", "event_id", "event_type", "value")
    return apply_changes(base, log_slice(log, middle, end), ["user_id"])
