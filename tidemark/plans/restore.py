"""Rebuilding a table from its last full snapshot and the increments after it."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from tidemark.functions.coordinates import Coordinate
from tidemark.functions.stamps import stamp
from tidemark.operators.changes import DELETE_OPS, latest_changes
from tidemark.operators.restore import apply_changes, upsert, upsert_partitions
from tidemark.plans.backup import FULL, INCREMENTAL, LOG_INCREMENT, SCHEMA
from tidemark.sinks.fanout import run_jobs
from tidemark.sinks.formats import PARQUET, read_artifact, with_marks
from tidemark.sources.catalog import CATALOG_SCHEMA, empty_tables
from tidemark.sources.manifests import parsed_meta, read_manifests
from tidemark.workspace import materialise

SET_COLUMN = "__set"  # taken from the path; no column of a table is mistaken for it


class ChainError(ValueError):
    """The increments after the full snapshot do not join up."""


class Chain(NamedTuple):
    full: Row
    increments: list[Row]


def backup_chain(
    spark: SparkSession,
    base: str,
    database: str,
    driver: str,
    until: datetime | str,
    table: tuple[str, str] | None = None,
) -> Chain:
    """The last full set stamped at or before `until` and every later increment up to it.

    With `table`, the last full set that holds it. The rows are the chain of one database: as
    many as there are increments since that set.
    """
    full_sets = _sets(spark, base, database, driver, FULL).filter(F.col("set_ts") <= stamp(until))
    if table is not None:
        schema_name, table_name = table
        full_sets = full_sets.filter(
            F.exists(
                "info.tables",
                lambda t: (t["schema_name"] == schema_name) & (t["table_name"] == table_name),
            )
        )
    full = _only(full_sets, table).orderBy(F.desc("set_ts"), F.desc("manifest")).first()
    if full is None:
        raise ChainError(f"no full set of {database} at or before {until}")
    later = _sets(spark, base, database, driver, INCREMENTAL).filter(
        (F.col("set_ts") > full.set_ts) & (F.col("set_ts") <= stamp(until))
    )
    return Chain(full, _only(later, table).orderBy("set_ts", "manifest").collect())


def _sets(spark: SparkSession, base: str, database: str, driver: str, mode: str) -> DataFrame:
    return parsed_meta(read_manifests(spark, base, database=database, driver=driver, mode=mode))


def _only(sets: DataFrame, table: tuple[str, str] | None) -> DataFrame:
    """The few fields that a chain needs, of one table if it is named: all that comes to the driver."""
    info = F.col("info")
    if table is not None:
        own = lambda t: (t["schema_name"] == table[0]) & (t["table_name"] == table[1])
        lost = F.filter("info.failed", lambda name: name == ".".join(table))
        info = info.withField("tables", F.filter("info.tables", own)).withField("failed", lost)
    return sets.select("manifest", "set_ts", F.when(F.col("info").isNotNull(), info).alias("info"))


def _instant(value: datetime | None) -> float | None:
    # Rows carry local clock times, which repeat for an hour where clocks are set back.
    return value.timestamp() if value is not None else None


def require_joined(chain: Chain, table_name: str) -> None:
    """Each increment must start no later than where the one before it, or the full set, ended.

    An increment that failed for this table counts for nothing: a later one has to make up for it.
    """
    full = chain.full.info
    reached = _instant(full.upper_utc)
    position = Coordinate(*full["to"]).order if full["to"] is not None else None
    for increment in chain.increments:
        info = increment.info
        if info is None:
            raise ChainError(f"{increment.manifest} does not say what it covers")
        lost = table_name in (info.failed or [])
        if info.incremental_type == LOG_INCREMENT:
            start, end = Coordinate(*info["from"]).order, Coordinate(*info["to"]).order
            joined = position is None or start <= position
            position = position if lost else end if position is None else max(position, end)
        else:
            since, upper = _instant(info.since_utc), _instant(info.next_since_utc)
            joined = reached is None or since <= reached
            reached = reached if lost else upper if reached is None else max(reached, upper)
        if not joined:
            raise ChainError(f"{increment.manifest} does not join what was extracted before it")
    if chain.increments and table_name in (chain.increments[-1].info.failed or []):
        raise ChainError(f"{chain.increments[-1].manifest} failed for {table_name}")


def _entry(manifest: Row, schema_name: str, table_name: str) -> Row | None:
    for entry in (manifest.info and manifest.info.tables) or []:
        if (entry.schema_name, entry.table_name) == (schema_name, table_name):
            return entry
    return None


def _schema(entry: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry.schema_json))


def restore_snapshot(
    spark: SparkSession, base: str, manifest: Row, schema_name: str, table_name: str
) -> DataFrame:
    """A table exactly as one full set holds it."""
    entry = _entry(manifest, schema_name, table_name)
    if entry is None:
        raise KeyError(f"{schema_name}.{table_name} is not in {manifest.manifest}")
    return read_artifact(spark, f"{base.rstrip('/')}/{entry.path}", _schema(entry), fmt=entry.format)


def merged_schema(schemas: Sequence[T.StructType], name: str) -> T.StructType:
    """Columns of successive versions of a table: those added later come behind. A column that
    vanished or changed its type is an error."""
    merged = schemas[0]
    for schema in schemas[1:]:
        types = {f.name: f.dataType for f in schema.fields}
        changed = [f.name for f in merged.fields if types.get(f.name) != f.dataType]
        if changed:
            raise ChainError(f"columns of {name} changed within its chain: {changed}")
        known = set(merged.names)
        merged = T.StructType([*merged.fields, *[f for f in schema.fields if f.name not in known]])
    return merged


def read_increments(
    spark: SparkSession, base: str, increments: Sequence[Row], schema_name: str, table_name: str
) -> DataFrame | None:
    """One table's rows of several increments, with the set each came from as `__set`.

    All parquet sets are a single scan, however many there are; CSV sets are one for each schema.
    Columns that a later set added are NULL in rows of the sets before it.
    """
    entries = [e for m in increments if (e := _entry(m, schema_name, table_name)) is not None]
    if not entries:
        return None
    schema = merged_schema([_schema(e) for e in entries], f"{schema_name}.{table_name}")
    root = None
    if increments[0].info.incremental_type == LOG_INCREMENT:
        # Slices have folders of their own inside, so that Spark reads the path from here on.
        if "set" in schema.names:
            raise ValueError("a change table's column `set` would be taken for the path's: rename it")
        root = f"{base.rstrip('/')}/{entries[0].path.rpartition('/')[0]}"
    groups: dict[tuple, list[str]] = {}
    for e in entries:
        own = schema if e.format == PARQUET else _schema(e)
        groups.setdefault((e.format, own.json()), []).append(f"{base.rstrip('/')}/{e.path}")
    scans = [
        read_artifact(spark, paths, T.StructType.fromJson(json.loads(own)), fmt=fmt, base_path=root, set_as=SET_COLUMN)
        for (fmt, own), paths in sorted(groups.items())
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    return with_marks(rows.select(*[F.col(f"`{n}`") for n in schema.names], SET_COLUMN), schema)


def restore_table(
    spark: SparkSession,
    base: str,
    database: str,
    schema_name: str,
    table_name: str,
    keys: Sequence[str],
    *,
    driver: str = "pgsql",
    until: datetime | str,
    op_column: str = "op",
    delete_ops: Sequence[str] = DELETE_OPS,
    check_base: bool = False,
) -> DataFrame:
    """The table as of `until`: last full set, then the last version of every changed key.

    Watermark increments are upserted, so deletes between full sets are not seen; change slices
    are replayed in log order, deletes included. `check_base` makes sure that the full set holds
    each key once, which shuffles all of its keys.
    """
    chain = backup_chain(spark, base, database, driver, until, (schema_name, table_name))
    return _restored(
        spark, base, chain, schema_name, table_name, keys, op_column=op_column, delete_ops=delete_ops, check_base=check_base
    )


def restore_set(
    spark: SparkSession,
    base: str,
    database: str,
    keys: Mapping[str, Sequence[str]],
    *,
    driver: str = "pgsql",
    until: datetime | str,
    op_column: str = "op",
    delete_ops: Sequence[str] = DELETE_OPS,
    check_base: bool = False,
    max_parallel: int = 4,
) -> dict[str, DataFrame]:
    """All tables of the last full set as of `until`, by `schema.table`.

    One chain is planned for all. `keys` names the key columns of each table that increments change;
    a changed table without is an error before anything is read. Each table's increments are read
    once, side by side; its unchanged rows are read from the full set as the result is.
    """
    chain = backup_chain(spark, base, database, driver, until)
    names = [(e.schema_name, e.table_name) for e in (chain.full.info and chain.full.info.tables) or []]
    changed = {(e.schema_name, e.table_name) for m in chain.increments for e in (m.info and m.info.tables) or []}
    unkeyed = sorted(".".join(n) for n in names if n in changed and ".".join(n) not in keys)
    if unkeyed:
        raise KeyError(f"increments change tables without keys: {unkeyed}")
    if absent := sorted(set(keys) - {".".join(n) for n in names}):
        raise KeyError(f"not in {chain.full.manifest}: {absent}")

    def one(name: tuple[str, str]) -> DataFrame:
        return _restored(
            spark, base, chain, *name, keys.get(".".join(name), ()), op_column=op_column, delete_ops=delete_ops, check_base=check_base
        )

    return dict(zip([".".join(n) for n in names], run_jobs(spark, one, names, max_parallel), strict=True))


def _restored(
    spark: SparkSession, base: str, chain: Chain, schema_name: str, table_name: str, keys: Sequence[str], *,
    op_column: str, delete_ops: Sequence[str], check_base: bool,
) -> DataFrame:
    """A table's full set with its increments. The last version of each changed key is stored once."""
    require_joined(chain, f"{schema_name}.{table_name}")
    table = restore_snapshot(spark, base, chain.full, schema_name, table_name)
    changed = read_increments(spark, base, chain.increments, schema_name, table_name)
    if changed is None:
        return table
    if chain.increments[0].info.incremental_type == LOG_INCREMENT:
        return apply_changes(table, changed, keys, op_column=op_column, delete_ops=delete_ops, check_base=check_base)
    merged_schema([table.schema, changed.drop(SET_COLUMN).schema], f"{schema_name}.{table_name}")
    latest = materialise(latest_changes(changed, keys, order=[SET_COLUMN]).drop(SET_COLUMN), "latest")
    return upsert(table, latest, keys, allow_missing_columns=True, check_keys=False, check_base=check_base)


def restore_schema(
    spark: SparkSession, base: str, database: str, *, driver: str = "pgsql", until: datetime | str
) -> dict[str, DataFrame]:
    """Every table of the last schema set at or before `until`, by `schema.table`, without rows.

    All catalogs of the set, one or one for each schema, are read in one scan.
    """
    sets = _only(_sets(spark, base, database, driver, SCHEMA).filter(F.col("set_ts") <= stamp(until)), None)
    newest = sets.orderBy(F.desc("set_ts"), F.desc("manifest")).first()
    if newest is None:
        raise ChainError(f"no schema set of {database} at or before {until}")
    entries = newest.info.tables if newest.info and newest.info.tables else []
    found: dict[str, DataFrame] = {}
    by_format: dict[str, list[str]] = {}
    for e in entries:
        by_format.setdefault(e.format, []).append(f"{base.rstrip('/')}/{e.path}")
    for fmt, paths in by_format.items():
        catalog = read_artifact(spark, paths, T.StructType.fromDDL(CATALOG_SCHEMA), fmt=fmt)
        found |= empty_tables(spark, catalog)
    return found


def write_restored(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a restored table to a new place; a place that already holds data is refused."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def upsert_in_place(
    target: str,
    schema: T.StructType,
    increment: DataFrame,
    keys: Sequence[str],
    partition_keys: Sequence[str],
    *,
    check_keys: bool = True,
    check_base: bool = False,
) -> None:
    """Upsert into a parquet table stored by `partition_keys`, replacing only touched partitions.

    Their new content is stored elsewhere first, so nothing is overwritten while it is read, and
    a run that dies while replacing can be repeated. The rebalance splits a large partition over
    many files and gives a small one few.
    """
    spark = increment.sparkSession
    stored = read_artifact(spark, target, schema)
    content = materialise(
        upsert_partitions(stored, increment, keys, partition_keys, check_keys=check_keys, check_base=check_base),
        "touched-content",
    )
    (
        content.hint("rebalance", *partition_keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_keys)
        .parquet(target)
    )
