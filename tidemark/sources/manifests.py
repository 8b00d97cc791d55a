"""Manifests: one JSON document per backup set, read as a table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.names import (
    DRIVER_ABBREVIATIONS,
    MANIFEST_SUFFIX,
    TOKEN_PATTERN,
    sanitise_text,
    set_token,
    set_ts,
)
from tidemark.workspace import Storage

MANIFEST_DIR = "_manifests"
INDEX_DIR = "_index"  # below MANIFEST_DIR: hidden from Spark's readers of documents
INDEX_ROWS = 100_000  # in one file of an index
# `meta` stays text: it is an object for some modes and an empty list for others.
MANIFEST_SCHEMA = (
    "at_utc timestamp, connection string, driver string, database string, mode string, "
    "gzip boolean, note string, files array<string>, meta string"
)
INDEX_SCHEMA = f"manifest string, {MANIFEST_SCHEMA}"
INDEX_COLUMNS = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
COORDINATE_TYPE = "struct<file:string,pos:bigint>"
TABLE_ENTRY_TYPE = (
    "struct<schema_name:string,table_name:string,path:string,raw_path:string,format:string,"
    "n_rows:bigint,max_watermark:string,read_utc:string,schema_json:string>"
)
META_TYPE = (
    "incremental_type string, since_utc timestamp, next_since_utc timestamp, "
    f"`from` {COORDINATE_TYPE}, `to` {COORDINATE_TYPE}, upper_utc timestamp, "
    f"tables array<{TABLE_ENTRY_TYPE}>, failed array<string>"
)
SET_KEY = ["destination", "database", "driver", "mode", "set_token"]


def manifest_location(base: str) -> str:
    return f"{base.rstrip('/')}/{MANIFEST_DIR}"


def with_tokens(manifests: DataFrame, name_column: str = "manifest") -> DataFrame:
    """Add `set_token` and `set_ts`; both are NULL for a name without a token."""
    token = set_token(F.col(name_column))
    return manifests.withColumn("set_token", token).withColumn("set_ts", set_ts(F.col("set_token")))


def _documents(spark: SparkSession, paths: str | list[str], destination: str, pattern: str | None = None) -> DataFrame:
    reader = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).option("mode", "FAILFAST")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.json(paths).select(
        F.lit(destination).alias("destination"), F.col("_metadata.file_name").alias("manifest"), "*"
    )


def family_prefix(database: str, driver: str | None = None, mode: str | None = None) -> str:
    """What the names of a database's, or one of its families', manifests start with."""
    parts = [sanitise_text(database)]
    if driver is not None:
        parts.append(DRIVER_ABBREVIATIONS[driver])
        if mode is not None:
            parts.append(mode)
    return "_".join(parts) + "_"


def read_manifests(
    spark: SparkSession,
    base: str,
    destination: str = "",
    *,
    database: str | None = None,
    driver: str | None = None,
    mode: str | None = None,
) -> DataFrame:
    """The manifests directly below `<base>/_manifests`. A malformed document is an error.

    With `database`, and `driver` and `mode` besides, only documents whose names start as that
    family's do are opened, and those that `compact_manifests` has put into the family's index are
    read from it. The documents stay the truth: an indexed set whose document is gone is no set.
    """
    if database is None:
        return with_tokens(_documents(spark, manifest_location(base), destination, f"*{MANIFEST_SUFFIX}"))
    found = _named_like(spark, base, destination, family_prefix(database, driver, mode))
    # Other databases' names may start alike.
    for name, value in (("database", database), ("driver", driver), ("mode", mode)):
        if value is not None:
            found = found.filter(F.col(name) == value)
    return with_tokens(found)


def _named_like(spark: SparkSession, base: str, destination: str, prefix: str) -> DataFrame:
    """The manifests whose names start with `prefix`: from indexes, and the others from their documents."""
    where = manifest_location(base)
    if not Storage(spark).exists(where):
        return spark.createDataFrame([], f"destination string, {INDEX_SCHEMA}")
    indexes = _newest_indexes(spark, base, prefix)
    if not indexes:
        return _documents(spark, where, destination, f"{prefix}*{MANIFEST_SUFFIX}")
    listed = Storage(spark).matching_names(f"{where}/{prefix}*{MANIFEST_SUFFIX}")
    indexed = spark.read.schema(INDEX_SCHEMA).parquet(*indexes)
    kept = {r.manifest for r in indexed.select("manifest").collect()}
    tail = [f"{where}/{name}" for name in listed if name not in kept]
    alive = spark.createDataFrame([(n,) for n in listed if n in kept], "manifest string")
    found = indexed.join(alive, "manifest", "left_semi").select(F.lit(destination).alias("destination"), *INDEX_COLUMNS)
    return found.unionByName(_documents(spark, tail, destination)) if tail else found


def _newest_indexes(spark: SparkSession, base: str, prefix: str) -> list[str]:
    """The last whole index of every family that the prefix covers: one folder for each version."""
    done = Storage(spark).matching_paths(f"{manifest_location(base)}/{INDEX_DIR}/{prefix}*/v=*/_SUCCESS")
    newest: dict[str, str] = {}
    for path in done:  # in order of names, versions have equal lengths
        version = path.rpartition("/")[0]
        newest[version.rpartition("/")[0]] = version
    return list(newest.values())


def compact_manifests(
    spark: SparkSession, base: str, database: str, driver: str, mode: str, *, least: int = 64
) -> bool:
    """Put one family's documents into its index if at least `least` of them, and a quarter as many
    as are indexed, came since the last time: each is rewritten a few times at most, however long
    the history. A new version is whole once Spark has marked it so; the one before stays for
    readers that have begun, older ones go."""
    where, prefix = manifest_location(base), family_prefix(database, driver, mode)
    storage, own = Storage(spark), f"{manifest_location(base)}/{INDEX_DIR}/{prefix}"
    names = storage.matching_names(f"{where}/{prefix}*{MANIFEST_SUFFIX}")
    listed = sum(bool(re.fullmatch(TOKEN_PATTERN, n[len(prefix) - 1 :])) for n in names)
    if listed < least:
        return False
    current = [x for x in _newest_indexes(spark, base, prefix) if x.rpartition("/")[0].endswith(f"/{prefix}")]
    kept = spark.read.schema(INDEX_SCHEMA).parquet(*current).count() if current else 0
    if listed - kept < max(least, kept // 4):
        return False
    versions = storage.matching_paths(f"{own}/v=*")
    number = int(versions[-1].rpartition("=")[2]) + 1 if versions else 0
    rows = _named_like(spark, base, "", prefix).filter(F.substring("manifest", len(prefix), 1 << 20).rlike(f"^{TOKEN_PATTERN}"))
    rows.select(*INDEX_COLUMNS).coalesce(1 + listed // INDEX_ROWS).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true"
    ).parquet(f"{own}/v={number:09d}")
    for old in versions[:-1]:
        storage.delete(old)
    return True


def parsed_meta(manifests: DataFrame) -> DataFrame:
    """Add the decoded `meta` as a struct column `info`; dump manifests decode to NULLs."""
    body = F.when(F.startswith(F.ltrim("meta"), F.lit("{")), F.col("meta"))
    return manifests.withColumn("info", F.from_json(body, META_TYPE))


def manifest_artifacts(manifests: DataFrame) -> DataFrame:
    """One row per file that a manifest lists; no directory is scanned."""
    keep = [c for c in SET_KEY if c in manifests.columns]
    return manifests.select(*keep, "manifest", F.explode("files").alias("path"))
