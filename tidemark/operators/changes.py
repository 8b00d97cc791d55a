"""Ordered change logs: inventory, slices, gaps and replay.

A change table has `file`, `pos` and an operation column; `seq` is the file's numeric suffix and,
in a stored log, its partition column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.coordinates import FIRST_POSITION, Coordinate, in_range, log_seq
from tidemark.sources.tables import Table
from tidemark.workspace import union_all

DELETE_OPS = ("delete",)
SHOWN_GAPS = 20
FILE_NUMBER = {"tidemark": "file number"}


class LogGapError(ValueError):
    """Part of the requested log range is not there; state must not advance."""


def declare_seq(changes: DataFrame) -> DataFrame:
    """Say that the column `seq` of a stored log is its files' number, by which it is partitioned."""
    return changes.withMetadata("seq", FILE_NUMBER)


def with_seq(changes: DataFrame) -> DataFrame:
    """Add `seq`, the number of the file. A column of that name is only believed if it was made here
    or declared; any other is the user's own and must be renamed, for it would be misread."""
    if "seq" not in changes.columns:
        return changes.withColumn("seq", log_seq(F.col("file"))).withMetadata("seq", FILE_NUMBER)
    if changes.schema["seq"].metadata != FILE_NUMBER:
        raise ValueError("`seq` is reserved for the file's number: rename it, or declare_seq if it is that")
    return changes


def log_coordinates(tables: Sequence[Table]) -> DataFrame:
    """The coordinates of several change tables that share one log."""
    parts = [with_seq(t.df).select("file", "seq", "pos") for t in tables]
    return union_all(parts)


def log_inventory(changes: DataFrame) -> DataFrame:
    """Every log file with its positions, in natural order of the names."""
    return (
        with_seq(changes)
        .groupBy("seq", "file")
        .agg(
            F.min("pos").alias("first_pos"),
            F.max("pos").alias("last_pos"),
            F.count(F.lit(1)).alias("n_events"),
        )
        .orderBy("seq")
    )


def log_end_row(changes: DataFrame) -> DataFrame:
    """The last event's coordinate as one row (`file`, `seq`, `pos`); no row for an empty log."""
    last = with_seq(changes).agg(F.max(F.struct("seq", "pos", "file")).alias("last"))
    return last.filter(F.col("last").isNotNull()).select("last.file", "last.seq", "last.pos")


def log_end(changes: DataFrame, from_seq: int | None = None) -> Coordinate:
    """Coordinate just past the last event: the exclusive end of a slice taken now.

    The last file is found first and only that file's positions are read. A run that resumes
    passes the file it starts in, and earlier ones are not looked at.
    """
    log = with_seq(changes)
    if from_seq is not None:
        log = log.filter(F.col("seq") >= from_seq)
    top = log.agg(F.max("seq").alias("seq")).first().seq
    if top is None:
        raise LogGapError(
            "the change log is empty or not accessible"
            if from_seq is None
            else f"the change log ends before file number {from_seq}; was it reset?"
        )
    last = log_end_row(log.filter(F.col("seq") == top)).first()
    return Coordinate(last.file, last.pos + 1)


def start_of_current(end: Coordinate) -> Coordinate:
    """Where a first run starts: the first event of the current file."""
    return Coordinate(end.file, FIRST_POSITION)


def log_slice(changes: DataFrame, start: Coordinate, end: Coordinate) -> DataFrame:
    """Events in the half-open range [start, end)."""
    return with_seq(changes).filter(in_range(F.col("seq"), F.col("pos"), start, end))


def log_gaps(
    changes: DataFrame, first_seq: int, last_seq: int, files: DataFrame | None = None
) -> DataFrame:
    """Files of the range, both boundaries included, that the log does not hold.

    `files` is a list of the log's files (column `file`), for a log where a file may hold no
    change of the tables at hand; without it, the files are those the changes come from.
    """
    present = (
        with_seq(changes if files is None else files)
        .filter(F.col("seq").between(first_seq, last_seq))
        .select("seq")
        .distinct()
    )
    expected = changes.sparkSession.range(first_seq, last_seq + 1).toDF("seq")
    return expected.join(present, "seq", "left_anti")


def require_complete(
    changes: DataFrame, start: Coordinate, end: Coordinate, files: DataFrame | None = None
) -> None:
    """Fail when the range runs backwards (the log was reset) or a file in it is missing."""
    if start.order > end.order:
        raise LogGapError(f"log starts after its end: {start} > {end}; was the log reset?")
    missing = log_gaps(changes, start.seq, end.seq, files)
    shown = [r.seq for r in missing.orderBy("seq").limit(SHOWN_GAPS).collect()]
    if shown:
        raise LogGapError(f"log files missing between {start.file} and {end.file}, first: {shown}")


def ordered_slice(events: DataFrame, cluster: bool = False) -> DataFrame:
    """A slice in log order inside each output partition, ready for `partitionBy("seq")`.

    A stored log is already laid out by file and needs no shuffle. With `cluster`, rows are first
    ranged by coordinate, which also spreads one very large file over many tasks.
    """
    if cluster:
        events = events.repartitionByRange("seq", "pos")
    return events.sortWithinPartitions("seq", "pos")


def latest_changes(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq", "pos")
) -> DataFrame:
    """The last change of every key. Partial aggregation keeps one row per key and task,
    so a key that holds most of the log reaches its reducer as a handful of rows."""
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("__last")
    return changes.groupBy(*keys).agg(last).select(
        *keys, *[F.col("__last").getField(c).alias(c) for c in rest]
    )


def replay(
    changes: DataFrame,
    keys: Sequence[str],
    *,
    op_column: str = "op",
    delete_ops: Sequence[str] = DELETE_OPS,
    order: Sequence[str] = ("seq", "pos"),
) -> DataFrame:
    """Rows alive after replaying a log in order from nothing."""
    latest = latest_changes(changes, keys, order)
    return latest.filter(~F.coalesce(F.col(op_column).isin(list(delete_ops)), F.lit(False)))
