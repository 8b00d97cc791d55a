"""Resume state: where the next increment of a (connection, driver) starts."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tidemark.functions.coordinates import Coordinate
from tidemark.functions.names import sanitise_text
from tidemark.sources.manifests import parsed_meta, read_manifests
from tidemark.workspace import Storage

STATE_TOKEN = r"_(\d{8}_\d{6})(?:_[A-Za-z0-9._-]+)?\.json$"
FULL_MODE = "full"
STATE_SCHEMA = (
    "connection string, driver string, set_id string, saved_utc timestamp, "
    "since_utc timestamp, file string, pos bigint"
)


def state_location(state_path: str, connection: str, driver: str) -> str:
    return f"{state_path.rstrip('/')}/{sanitise_text(connection)}_{driver}_state"


def latest_state(states: DataFrame) -> DataFrame:
    """The last saved row of every (connection, driver). Partial aggregation absorbs a busy key."""
    rest = [c for c in states.columns if c not in ("connection", "driver")]
    newest = F.max_by(F.struct(*rest), F.struct("saved_utc", "set_id")).alias("newest")
    return states.groupBy("connection", "driver").agg(newest).select(
        "connection", "driver", *[F.col(f"newest.{c}").alias(c) for c in rest]
    )


def read_states(
    spark: SparkSession, state_path: str, connection: str, driver: str, names: list[str] | None = None
) -> DataFrame:
    """All saved states of one key, or those of the named records: empty when none exist, an error
    when one is malformed."""
    path = state_location(state_path, connection, driver)
    if names is None and not Storage(spark).exists(path):
        return spark.createDataFrame([], STATE_SCHEMA)
    reader = spark.read.schema(STATE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST")
    if names is None:
        states = reader.option("pathGlobFilter", "*.json").json(path)
    else:
        states = reader.json([f"{path}/{n}" for n in names])
    # Two names can share a folder after sanitising.
    return states.filter((F.col("connection") == connection) & (F.col("driver") == driver))


def newest_states(spark: SparkSession, state_path: str, connection: str, driver: str) -> DataFrame:
    """The states of the latest second that has any of this key. Record names end in their set's
    token, so the listing tells which records to open: one or few, however long the history."""
    path = state_location(state_path, connection, driver)
    by_second: dict[str, list[str]] = {}
    for name in Storage(spark).matching_names(f"{path}/*.json"):
        token = re.search(STATE_TOKEN, name)
        by_second.setdefault(token[1] if token else "", []).append(name)
    if "" in by_second:  # names of another kind say nothing of their time
        return read_states(spark, state_path, connection, driver)
    for second in sorted(by_second, reverse=True):
        found = read_states(spark, state_path, connection, driver, by_second[second])
        if not found.isEmpty():
            return found
    return spark.createDataFrame([], STATE_SCHEMA)


def _newest_full(spark: SparkSession, base: str | None, connection: str, database: str | None, driver: str) -> Row | None:
    """What the newest full set of a connection says of where its increments start. The set's manifest
    is the commit record of both, so a run that dies leaves neither or both."""
    if base is None or database is None:
        return None
    sets = read_manifests(spark, base, database=database, driver=driver, mode=FULL_MODE)
    newest = parsed_meta(sets.filter(F.col("connection") == connection)).filter("info.upper_utc IS NOT NULL")
    return newest.orderBy(F.desc("set_ts"), F.desc("manifest")).select(
        F.unix_micros("info.upper_utc").alias("micros"), F.col("info.to.file").alias("file"), F.col("info.to.pos").alias("pos")
    ).first()


def _instant(micros: int | None) -> datetime | None:
    return None if micros is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def load_since(
    spark: SparkSession, state_path: str, connection: str, driver: str, *,
    base: str | None = None, database: str | None = None,
) -> datetime | None:
    """The saved watermark as an aware UTC instant; where the key has no state, the upper bound of
    the newest full set at `base`; else None."""
    states = latest_state(newest_states(spark, state_path, connection, driver))
    row = states.select(F.unix_micros("since_utc").alias("micros")).first()
    if row is None:
        row = _newest_full(spark, base, connection, database, driver)
    return _instant(row.micros) if row is not None else None


def load_coordinate(
    spark: SparkSession, state_path: str, connection: str, driver: str, *,
    base: str | None = None, database: str | None = None,
) -> Coordinate | None:
    """The saved log coordinate; where the key has no state, where the log stood at the newest full
    set; else None."""
    row = latest_state(newest_states(spark, state_path, connection, driver)).select("file", "pos").first()
    if row is None:
        row = _newest_full(spark, base, connection, database, driver)
    return Coordinate(row.file, row.pos) if row is not None and row.file is not None else None
