"""Incremental extracts as Structured Streaming jobs that drain their source and stop.

The checkpoint is the resume state: a second run reads only what has arrived since.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.coordinates import Coordinate
from tidemark.functions.names import DRIVER_ABBREVIATIONS, sanitise_text
from tidemark.functions.stamps import as_utc, iso, stamp
from tidemark.operators.changes import latest_changes, ordered_slice, with_seq
from tidemark.operators.placement import destination_bases
from tidemark.plans.backup import INCREMENTAL as INCREMENTAL_MODE
from tidemark.plans.backup import LOG_INCREMENT as LOG_TYPE
from tidemark.plans.backup import WATERMARK_INCREMENT as WATERMARK_TYPE
from tidemark.sinks.fanout import copy_artifact
from tidemark.sinks.formats import PARQUET, with_marks, write_artifact
from tidemark.sinks.records import manifest_name_text, write_manifest
from tidemark.sources.manifests import compact_manifests, manifest_location
from tidemark.workspace import Storage

BATCH_DIR = "batch"
SETS_DIR = "sets"  # below the checkpoint: which set each batch is
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def file_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    *,
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Parquet files of a directory as a stream of the files that arrive in it."""
    reader = spark.readStream.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_marks(reader.parquet(directory), schema)


def drain(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Hand everything that is available to `handle`, batch by batch, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_extract(
    stream: DataFrame,
    bases: Sequence[str],
    checkpoint: str,
    *,
    compression: str | None = None,
    partition_by: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Write every batch to all destinations, below `batch=<id>`.

    A batch repeated after a failure has the same id and overwrites its own output. Batches
    without rows leave nothing.
    """
    first, *others = bases

    def handle(rows: DataFrame, batch_id: int) -> None:
        rows = prepare(rows)
        below = f"{BATCH_DIR}={batch_id}"
        written = write_artifact(
            rows, f"{first}/{below}", compression=compression,
            partition_by=partition_by, mode="overwrite",
        )
        if written.n_rows == 0:
            Storage(rows.sparkSession).delete(f"{first}/{below}")
            return
        copy_artifact(
            rows.sparkSession, f"{first}/{below}", [f"{b}/{below}" for b in others], rows.schema,
            fmt=PARQUET, compression=compression, partition_by=partition_by, mode="overwrite",
        )

    return drain(stream, checkpoint, handle)


def stream_changes(
    stream: DataFrame, bases: Sequence[str], checkpoint: str, *, cluster: bool = False
) -> StreamingQuery:
    """Slice a change log that grows file by file; each batch is in log order per partition."""
    return stream_extract(
        with_seq(stream), bases, checkpoint, partition_by=("seq",),
        prepare=lambda rows: ordered_slice(rows, cluster),
    )


def stream_sets(
    stream: DataFrame,
    checkpoint: str,
    *,
    database: str,
    schema_name: str,
    table_name: str,
    destinations: Mapping[str, str],
    remote_map: str | Mapping[str, str] | None = None,
    remote_path: str = "",
    connection: str | None = None,
    driver: str = "pgsql",
    log: bool = False,
    since: datetime | str = EPOCH,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    compression: str | None = None,
    cluster: bool = False,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> StreamingQuery:
    """Drain a stream into incremental sets, one for each batch with rows, each of which is whole or absent.

    Before a batch is written, its number is bound to a set's token and range in a record below the
    checkpoint; a batch that is repeated finds the record and writes the same set anew, so however
    often a run dies, a batch is one set. Its manifest comes last: restore, retention and listings
    see the set then, at every destination, and what a dead run left before is never read.

    A watermark set says that it holds what arrived after the set before it, or after `since`; where a
    batch may hold several versions of a row, `keys` and `order` keep the last one. With
    `log` the stream is a change table whose files arrive in the log's order, and a set spans the
    coordinates from where the one before it ended, or from its first change; files that come before
    their predecessors make a chain that restore refuses. `mysql` is the driver of such chains.
    """
    if driver not in DRIVER_ABBREVIATIONS:
        raise ValueError(f"unsupported driver {driver!r}")
    bases = list(destination_bases(destinations, remote_map, remote_path).values())
    folder = "/".join(sanitise_text(p) for p in (database, INCREMENTAL_MODE, schema_name, table_name))
    records = f"{checkpoint.rstrip('/')}/{SETS_DIR}"

    def record_of(storage: Storage, batch_id: int) -> dict | None:
        path = f"{records}/{batch_id}.json"
        return json.loads(storage.read_text(path)) if storage.exists(path) else None

    def bound(storage: Storage, rows: DataFrame, batch_id: int) -> dict:
        """The batch's record, made if this is the first try."""
        record = record_of(storage, batch_id)
        if record is not None:
            return record
        before = record_of(storage, batch_id - 1) if batch_id else None
        at = as_utc(clock()).replace(microsecond=0)
        if before is not None:  # one second holds one set
            at = max(at, as_utc(before["at_utc"]) + timedelta(seconds=1))
        record = {"token": stamp(at), "at_utc": iso(at), "empty": rows.isEmpty()}
        if log:
            low, high = rows.agg(F.min(F.struct("seq", "pos", "file")), F.max(F.struct("seq", "pos", "file"))).first()
            end = before and before.get("to")
            if low is not None:
                first, past = [low.file, low.pos], [high.file, high.pos + 1]
                record["from"] = first if end is None else min(end, first, key=lambda c: Coordinate(*c).order)
                record["to"] = past if end is None else max(end, past, key=lambda c: Coordinate(*c).order)
            elif end is not None:
                record["to"] = end
        else:
            # A batch without rows is no set: the next one starts where it would have.
            record["since_utc"] = iso(since) if before is None else before["since_utc" if before["empty"] else "at_utc"]
        storage.write_text(f"{records}/{batch_id}.json", json.dumps(record))
        return record

    def handle(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        storage = Storage(spark)
        rows = with_seq(rows) if log else rows
        record = bound(storage, rows, batch_id)
        name = manifest_name_text(database, driver, INCREMENTAL_MODE, record["token"])
        partition_by = ("seq",) if log else ()
        path = f"{folder}/set={record['token']}"
        first, *others = bases
        if log:
            body = ordered_slice(rows, cluster)
        else:
            body = latest_changes(rows, keys, order).select(rows.columns) if keys else rows
        written = write_artifact(body, f"{first}/{path}", compression=compression, partition_by=partition_by, mode="overwrite")
        if written.n_rows == 0:
            storage.delete(f"{first}/{path}")
            return
        copy_artifact(
            spark, f"{first}/{path}", [f"{b}/{path}" for b in others], rows.schema,
            fmt=PARQUET, compression=compression, partition_by=partition_by, mode="overwrite",
        )
        if log:
            span = {k: dict(zip(("file", "pos"), record[k], strict=True)) for k in ("from", "to")}
            meta = {"incremental_type": LOG_TYPE, **span}
        else:
            meta = {"incremental_type": WATERMARK_TYPE, "since_utc": record["since_utc"], "next_since_utc": record["at_utc"]}
        entry = {
            "schema_name": schema_name, "table_name": table_name, "path": path, "raw_path": None, "format": PARQUET,
            "n_rows": written.n_rows, "max_watermark": None, "read_utc": record["at_utc"], "schema_json": rows.schema.json(),
        }
        manifest = {
            "at_utc": record["at_utc"], "connection": connection or database, "driver": driver, "database": database,
            "mode": INCREMENTAL_MODE, "gzip": compression == "gzip", "note": None, "files": [path],
            "meta": meta | {"tables": [entry], "failed": [], "errors": {}},
        }
        for base in bases:
            if not storage.exists(f"{manifest_location(base)}/{name}"):  # a repeated batch may have got this far
                write_manifest(spark, base, name, manifest)
            compact_manifests(spark, base, database, driver, INCREMENTAL_MODE)

    return drain(stream, checkpoint, handle)


def read_extracted(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """All batches written so far, with the batch each row came in."""
    if BATCH_DIR in schema.names:
        raise ValueError(f"a column `{BATCH_DIR}` would be taken for the batch's number: rename it")
    columns = T.StructType([*schema.fields, T.StructField(BATCH_DIR, T.LongType())])
    return with_marks(spark.read.schema(columns).parquet(base), schema)


def read_unique(spark: SparkSession, base: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """All batches written so far with one row for each key, that of the first batch it came in.

    Rows are written as they arrive, however late; nothing is forgotten, and no state grows.
    """
    rows = read_extracted(spark, base, schema)
    own = F.struct(*[F.col(f"`{name}`") for name in schema.names])
    first = F.min_by(own, F.struct(BATCH_DIR, F.xxhash64(own)))
    return rows.groupBy(*keys).agg(first.alias("__first")).select("__first.*")
