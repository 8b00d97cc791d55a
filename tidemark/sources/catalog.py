"""The column catalog of a table set, and what is looked up in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.tables import TABLE, Table
from tidemark.workspace import union_all

CATALOG_SCHEMA = (
    "schema_name string, table_name string, kind string, ordinal int, "
    "column_name string, data_type string, nullable boolean"
)
# Schemas that belong to the server, never to the user.
SYSTEM_SCHEMAS = ["pg_catalog", "information_schema"]
WATERMARK_TYPES = ["timestamp", "timestamp_ntz", "date"]


def catalog_columns(spark: SparkSession, tables: Sequence[Table]) -> DataFrame:
    """One row per column, from the schemas alone; this is the schema-only snapshot."""
    rows = [
        (t.schema_name, t.table_name, t.kind, i, f.name, f.dataType.simpleString(), f.nullable)
        for t in tables
        for i, f in enumerate(t.df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def empty_table(spark: SparkSession, catalog: DataFrame, schema_name: str, table_name: str) -> DataFrame:
    """Restore a table's definition, without rows, from its catalog rows."""
    columns = (
        catalog.filter((F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))
        .orderBy("ordinal")
        .select("column_name", "data_type", "nullable")
        .collect()
    )
    if not columns:
        raise KeyError(f"{schema_name}.{table_name}")
    fields = [
        T.StructField(c.column_name, T.DataType.fromDDL(c.data_type), c.nullable) for c in columns
    ]
    return spark.createDataFrame([], T.StructType(fields))


def empty_tables(spark: SparkSession, catalog: DataFrame) -> dict[str, DataFrame]:
    """All tables of a catalog by `schema.table`, without rows. A catalog has one row for each column."""
    fields: dict[str, list[T.StructField]] = {}
    for c in catalog.orderBy("schema_name", "table_name", "ordinal").collect():
        own = fields.setdefault(f"{c.schema_name}.{c.table_name}", [])
        own.append(T.StructField(c.column_name, T.DataType.fromDDL(c.data_type), c.nullable))
    return {name: spark.createDataFrame([], T.StructType(own)) for name, own in fields.items()}


def user_schemas(catalog: DataFrame) -> DataFrame:
    return (
        catalog.select("schema_name")
        .distinct()
        .filter(~F.col("schema_name").isin(SYSTEM_SCHEMAS))
        .orderBy("schema_name")
    )


def user_tables(catalog: DataFrame) -> DataFrame:
    """Ordinary tables outside the system schemas."""
    return (
        catalog.filter((F.col("kind") == TABLE) & ~F.col("schema_name").isin(SYSTEM_SCHEMAS))
        .select("schema_name", "table_name")
        .distinct()
    )


def watermark_columns(catalog: DataFrame, column: str | None = None) -> DataFrame:
    """User tables joined with their watermark columns: those named `column`, or any of a fit type."""
    fits = (
        F.col("data_type").isin(WATERMARK_TYPES) if column is None else F.col("column_name") == column
    )
    columns = catalog.filter(fits).select("schema_name", "table_name", "column_name", "data_type")
    return (
        user_tables(catalog)
        .join(columns, ["schema_name", "table_name"], "inner")
        .orderBy("schema_name", "table_name", "column_name")
    )


def watermark_tables(catalog: DataFrame, column: str | None = None) -> DataFrame:
    """User tables for which a watermark column exists, ordered by name."""
    found = watermark_columns(catalog, column)
    return (
        user_tables(catalog)
        .join(found, ["schema_name", "table_name"], "left_semi")
        .orderBy("schema_name", "table_name")
    )


def table_counts(tables: Sequence[Table]) -> DataFrame:
    """Row count per table; each count is its own scan without columns."""
    counts = [
        t.df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t.schema_name).alias("schema_name"), F.lit(t.table_name).alias("table_name"), "n_rows"
        )
        for t in tables
    ]
    return union_all(counts)
