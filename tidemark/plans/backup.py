"""One backup run: extract, place, record, resume, expire - in that order."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.coordinates import Coordinate
from tidemark.functions.names import DRIVER_ALIASES, MANIFEST_SUFFIX, sanitise_text
from tidemark.functions.options import parse_count
from tidemark.functions.stamps import as_utc, iso
from tidemark.operators.changes import (
    log_coordinates,
    log_end,
    log_slice,
    ordered_slice,
    require_complete,
    start_of_current,
)
from tidemark.operators.incremental import Window, incremental_extract, resume_window
from tidemark.operators.placement import destination_bases
from tidemark.operators.selection import select_schemas, select_tables
from tidemark.plans.retention import apply_retention
from tidemark.sinks.fanout import copy_artifact, run_jobs
from tidemark.sinks.formats import PARQUET, write_artifact
from tidemark.sinks.records import manifest_name_text, save_state, set_token_text, write_manifest
from tidemark.sources.catalog import catalog_columns, user_tables, watermark_tables
from tidemark.sources.manifests import (
    MANIFEST_SCHEMA,
    compact_manifests,
    manifest_location,
    with_tokens,
)
from tidemark.sources.state import load_coordinate, load_since
from tidemark.sources.tables import Table
from tidemark.workspace import Storage

FULL, SCHEMA, INCREMENTAL = "full", "schema", "incremental"
MODES = (FULL, SCHEMA, INCREMENTAL)
ABORT, SKIP = "abort", "skip"
WATERMARK_INCREMENT, LOG_INCREMENT = "updated_at", "binlog"
CATALOG_ARTIFACT = "catalog_columns"
RAW_SUFFIX = ".raw"


@dataclass(frozen=True)
class Job:
    """One artifact to write: its rows and its table's folder below every destination base."""

    schema_name: str
    table_name: str
    df: DataFrame
    folder: str
    watermark: str | None = None
    partition_by: Sequence[str] = ()


@dataclass
class RunPlan:
    """What a run writes, what its manifest says about it, and the state it leaves."""

    jobs: list[Job]
    meta: dict
    resume: dict = field(default_factory=dict)


@dataclass
class Outcome:
    entries: list[dict] = field(default_factory=list)
    files: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)


def _canonical_driver(driver: str) -> str:
    try:
        return DRIVER_ALIASES[driver.lower()]
    except KeyError:
        raise ValueError(f"unsupported driver {driver!r}") from None


def _chosen_tables(
    tables: Sequence[Table], names: DataFrame, include: str | Iterable[str] | None,
    exclude: str | Iterable[str] | None,
) -> list[Table]:
    """Tables whose names pass the filters. Only names come to the driver, to submit their jobs."""
    wanted = {(r.schema_name, r.table_name) for r in select_tables(names, include, exclude).collect()}
    return sorted(
        (t for t in tables if (t.schema_name, t.table_name) in wanted), key=lambda t: t.name
    )


def _folder(database: str, mode: str, schema_name: str, table_name: str) -> str:
    parts = (database, mode, schema_name, table_name)
    return "/".join(sanitise_text(p) for p in parts if p != "")


def snapshot_plan(database: str, tables: Sequence[Table], upper: datetime, log: DataFrame | None) -> RunPlan:
    """Every table whole."""
    meta = {"upper_utc": iso(upper)}
    if log is not None:
        meta["to"] = log_end(log)._asdict()
    jobs = [
        Job(t.schema_name, t.table_name, t.df, _folder(database, FULL, t.schema_name, t.table_name))
        for t in tables
    ]
    return RunPlan(jobs, meta)


def schema_plan(
    spark: SparkSession, database: str, tables: Sequence[Table], upper: datetime, per_schema: bool
) -> RunPlan:
    """The columns of every table as one catalog, or as one per schema."""
    rows = catalog_columns(spark, tables).coalesce(1)
    if per_schema:
        parts = {s: rows.filter(F.col("schema_name") == s) for s in {t.schema_name for t in tables}}
    else:
        parts = {"": rows}
    jobs = [
        Job(s, CATALOG_ARTIFACT, part, _folder(database, SCHEMA, s, CATALOG_ARTIFACT))
        for s, part in sorted(parts.items())
    ]
    return RunPlan(jobs, {"upper_utc": iso(upper)})


def watermark_plan(database: str, tables: Sequence[Table], column: str, window: Window) -> RunPlan:
    """The rows of every table that changed within the window."""
    jobs = [
        Job(
            t.schema_name, t.table_name, incremental_extract(t.df, column, *window),
            _folder(database, INCREMENTAL, t.schema_name, t.table_name), watermark=column,
        )
        for t in tables
    ]
    meta = {
        "incremental_type": WATERMARK_INCREMENT,
        "since_utc": iso(window.since),
        "next_since_utc": iso(window.upper),
    }
    return RunPlan(jobs, meta, {"since": window.upper})


def log_plan(
    database: str, changes: Sequence[Table], start: Coordinate | None,
    files: DataFrame | None, cluster: bool,
) -> RunPlan:
    """The slice of every change table from `start` to where the log ends now."""
    log = log_coordinates(changes)
    end = log_end(log, start.seq if start else None)
    start = start or start_of_current(end)
    require_complete(log, start, end, files)
    jobs = [
        Job(
            t.schema_name, t.table_name, ordered_slice(log_slice(t.df, start, end), cluster),
            _folder(database, INCREMENTAL, t.schema_name, t.table_name), partition_by=("seq",),
        )
        for t in changes
    ]
    meta = {"incremental_type": LOG_INCREMENT, "from": start._asdict(), "to": end._asdict()}
    return RunPlan(jobs, meta, {"coordinate": end})


def _require_distinct(jobs: Sequence[Job]) -> None:
    taken: dict[str, str] = {}
    for job in jobs:
        name = f"{job.schema_name}.{job.table_name}"
        for path in (job.folder, job.folder + RAW_SUFFIX):
            if path in taken:
                raise ValueError(f"{taken[path]} and {name} have the same folder {path}")
            taken[path] = name


def _write_everywhere(
    spark: SparkSession, jobs: Sequence[Job], bases: Sequence[str], token: str, *,
    fmt: str, gzip: bool, keep_raw: bool, drop_empty: bool, on_error: str, max_parallel: int,
) -> Outcome:
    """Write each artifact once, copy what was written to the other destinations.

    No manifest names these paths yet, so what a failed run left there is overwritten.
    """
    storage = Storage(spark)
    first, *others = bases

    def one(job: Job) -> tuple[Job, dict | None, Exception | None]:
        versions = [(f"{job.folder}/set={token}", "gzip" if gzip else None)]
        if gzip and keep_raw:
            versions.append((f"{job.folder}{RAW_SUFFIX}/set={token}", "none"))
        try:
            read_at = datetime.now(timezone.utc)
            main, compression = versions[0]
            written = write_artifact(
                job.df, f"{first}/{main}", fmt=fmt, compression=compression,
                watermark=job.watermark, partition_by=job.partition_by, mode="overwrite",
            )
            if drop_empty and written.n_rows == 0:
                storage.delete(f"{first}/{main}")
                return job, None, None
            for path, codec in versions:
                targets = [f"{b}/{path}" for b in (others if path == main else bases)]
                copy_artifact(
                    spark, f"{first}/{main}", targets, job.df.schema,
                    fmt=fmt, compression=codec, partition_by=job.partition_by, mode="overwrite",
                )
            return job, {
                "schema_name": job.schema_name,
                "table_name": job.table_name,
                "path": main,
                "raw_path": versions[1][0] if len(versions) > 1 else None,
                "format": fmt,
                "n_rows": written.n_rows,
                "max_watermark": written.max_watermark,
                "read_utc": iso(read_at),
                "schema_json": job.df.schema.json(),
            }, None
        except Exception as error:
            if on_error != SKIP:
                raise
            return job, None, error

    outcome = Outcome()
    for job, entry, error in run_jobs(spark, one, jobs, max_parallel):
        if error is not None:
            outcome.failed[f"{job.schema_name}.{job.table_name}"] = str(error)
        elif entry is not None:
            outcome.entries.append(entry)
            outcome.files += [p for p in (entry["path"], entry["raw_path"]) if p]
    return outcome


def run_backup(
    spark: SparkSession,
    tables: Sequence[Table],
    *,
    database: str,
    destinations: Mapping[str, str],
    connection: str | None = None,
    driver: str = "pgsql",
    mode: str = FULL,
    at: datetime | str | None = None,
    note: str | None = None,
    fmt: str = PARQUET,
    gzip: bool = False,
    keep_raw: bool = False,
    per_schema: bool = False,
    include_schemas: str | Iterable[str] | None = None,
    exclude_schemas: str | Iterable[str] | None = None,
    include_tables: str | Iterable[str] | None = None,
    exclude_tables: str | Iterable[str] | None = None,
    watermark_column: str = "updated_at",
    since: datetime | str | None = None,
    lookback: timedelta = timedelta(0),
    changes: Sequence[Table] = (),
    log_files: DataFrame | None = None,
    log_start: Coordinate | None = None,
    cluster_changes: bool = False,
    remote_map: str | Mapping[str, str] | None = None,
    remote_path: str = "",
    state_path: str | None = None,
    retention_keep: int | str | None = None,
    retention_days: int | str | None = None,
    retention_dry_run: bool = False,
    on_error: str = ABORT,
    max_parallel: int = 4,
) -> DataFrame:
    """Run one backup and return its manifest as a one-row DataFrame.

    `destinations` maps each disk to its root location; `remote_map` and `remote_path` place the
    sets below it. Order of commitment: data at every destination, then the manifest at every
    destination, then the resume state, then retention. A run that fails earlier leaves at most
    data that no manifest names.

    `changes` are change tables, one per source table, that share one coordinate space; a log
    increment slices them, and a full set records where the log stood before its tables were read.
    `log_files` lists the log's files where some hold no change of these tables.

    Resume state belongs to a `connection`, by default the database itself. An increment without
    `since` starts where the last one of its connection ended, the first one where the newest full
    set stood: that set's manifest holds both, so a full set and increments with nothing but
    defaults make a chain.

    `at` is the run's clock: the set stamp, the upper bound of a watermark increment and the
    instant retention counts ages from. Tables are read one by one, not in one transaction; the
    common upper bound is what watermark increments agree on.
    """
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    if on_error not in (ABORT, SKIP):
        raise ValueError(f"unknown on_error {on_error!r}")
    if not destinations:
        raise ValueError("at least one destination is needed")
    if (include_schemas or exclude_schemas) and not per_schema:
        raise ValueError("schema filters go with per_schema")
    connection = connection or database
    driver = _canonical_driver(driver)
    # Checked before any data moves, so that a typo cannot fail a run that has already written.
    if not isinstance(retention_keep, int):
        retention_keep = parse_count(retention_keep, "retention_keep")
    retention_days = parse_count(retention_days, "retention_days")

    at = as_utc(at) if at is not None else datetime.now(timezone.utc)
    bases = destination_bases(destinations, remote_map, remote_path)
    first_base = next(iter(bases.values()))
    state_path = state_path or f"{first_base}/_state"
    token = set_token_text(at, note)
    name = manifest_name_text(database, driver, mode, token)
    for base in bases.values():
        if Storage(spark).exists(f"{manifest_location(base)}/{name}"):
            raise FileExistsError(f"{name} is already recorded at {base}")

    if mode == INCREMENTAL and driver == "mysql":
        if not changes:
            raise ValueError("a log increment needs change tables")
        start = log_start or load_coordinate(
            spark, state_path, connection, driver, base=first_base, database=database
        )
        plan = log_plan(database, changes, start, log_files, cluster_changes)
    elif mode == INCREMENTAL:
        saved = None
        if since is None:
            saved = load_since(spark, state_path, connection, driver, base=first_base, database=database)
        window = resume_window(at, since=since, saved=saved, lookback=lookback)
        names = watermark_tables(catalog_columns(spark, tables), watermark_column)
        chosen = _chosen_tables(tables, names, include_tables, exclude_tables)
        plan = watermark_plan(database, chosen, watermark_column, window)
    else:
        names = user_tables(catalog_columns(spark, tables))
        if per_schema:
            names = select_schemas(names, include_schemas, exclude_schemas)
        chosen = _chosen_tables(tables, names, include_tables, exclude_tables)
        if mode == SCHEMA:
            plan = schema_plan(spark, database, chosen, at, per_schema)
        else:
            plan = snapshot_plan(
                database, chosen, at, log_coordinates(changes) if changes else None
            )

    _require_distinct(plan.jobs)
    outcome = _write_everywhere(
        spark, plan.jobs, list(bases.values()), token,
        fmt=fmt, gzip=gzip, keep_raw=keep_raw, drop_empty=mode == INCREMENTAL,
        on_error=on_error, max_parallel=max_parallel,
    )

    manifest = {
        "at_utc": iso(at),
        "connection": connection,
        "driver": driver,
        "database": database,
        "mode": mode,
        "gzip": gzip,
        "note": note,
        "files": outcome.files,
        "meta": plan.meta | {
            "tables": outcome.entries, "failed": list(outcome.failed), "errors": outcome.failed,
        },
    }
    for base in bases.values():
        write_manifest(spark, base, name, manifest)
        compact_manifests(spark, base, database, driver, mode)

    if plan.resume and not outcome.failed:
        set_id = name.removesuffix(MANIFEST_SUFFIX)
        save_state(spark, state_path, connection, driver, set_id, at, **plan.resume)

    if retention_keep is not None or retention_days is not None:
        apply_retention(
            spark, bases, keep=retention_keep, days=retention_days, as_of=at,
            database=database, driver=driver, mode=mode, dry_run=retention_dry_run,
        )
    return manifest_row(spark, name, manifest)


def manifest_row(spark: SparkSession, name: str, manifest: dict) -> DataFrame:
    """A manifest document as the row that listing it would give."""
    text = spark.createDataFrame([(name, json.dumps(manifest))], "manifest string, body string")
    doc = text.select("manifest", F.from_json("body", MANIFEST_SCHEMA).alias("doc"))
    return with_tokens(doc.select("manifest", "doc.*"))
