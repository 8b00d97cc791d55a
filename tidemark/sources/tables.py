"""Table sets: the databases that are read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.workspace import Storage

TABLE = "TABLE"
VIEW = "VIEW"


@dataclass(frozen=True)
class Table:
    schema_name: str
    table_name: str
    df: DataFrame
    kind: str = TABLE

    @property
    def name(self) -> str:
        return f"{self.schema_name}.{self.table_name}"


def table_set(tables: Mapping[str, DataFrame], default_schema: str = "main") -> list[Table]:
    """Tables from `{"schema.table": df}`; a name without a dot goes to the default schema."""
    out = []
    for name, df in tables.items():
        schema, dot, table = name.partition(".")
        out.append(Table(schema, table, df) if dot else Table(default_schema, name, df))
    return out


def parquet_tables(
    spark: SparkSession,
    directory: str,
    names: Iterable[str] | None = None,
    schema_name: str = "main",
) -> list[Table]:
    """Every `<name>.parquet` of a directory, or the named ones, as tables of one schema."""
    if names is None:
        suffix = ".parquet"
        children = Storage(spark).child_names(directory)
        names = [c[: -len(suffix)] for c in children if c.endswith(suffix)]
    return [
        Table(schema_name, name, spark.read.parquet(f"{directory}/{name}.parquet")) for name in names
    ]


def catalog_tables(spark: SparkSession, schema_name: str) -> list[Table]:
    """Tables and views registered under one schema of the session catalog."""
    out = []
    for entry in spark.catalog.listTables(schema_name):
        if not entry.isTemporary:
            kind = VIEW if entry.tableType == "VIEW" else TABLE
            df = spark.table(f"`{schema_name}`.`{entry.name}`")
            out.append(Table(schema_name, entry.name, df, kind))
    return out


def find_table(tables: Sequence[Table], schema_name: str, table_name: str) -> Table:
    for table in tables:
        if (table.schema_name, table.table_name) == (schema_name, table_name):
            return table
    raise KeyError(f"{schema_name}.{table_name}")
