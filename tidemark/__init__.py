"""Recoverable copies of table sets on Spark: snapshots, increments, change logs, retention."""

from tidemark.functions.coordinates import Coordinate
from tidemark.operators.changes import LogGapError
from tidemark.operators.incremental import incremental_extract
from tidemark.operators.retention import expired_sets
from tidemark.plans.backup import run_backup
from tidemark.plans.restore import ChainError, restore_schema, restore_set, restore_table, upsert_in_place
from tidemark.plans.retention import apply_retention
from tidemark.sources.databases import database_catalog, database_tables, jdbc_table
from tidemark.sources.tables import Table, catalog_tables, parquet_tables, table_set

__all__ = [
    "ChainError",
    "Coordinate",
    "LogGapError",
    "Table",
    "apply_retention",
    "catalog_tables",
    "database_catalog",
    "database_tables",
    "expired_sets",
    "incremental_extract",
    "jdbc_table",
    "parquet_tables",
    "restore_schema",
    "restore_set",
    "restore_table",
    "run_backup",
    "table_set",
    "upsert_in_place",
]
