"""Choosing schemas and tables of a catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.options import parse_list
from tidemark.functions.patterns import matches_any


def select_schemas(
    schemas: DataFrame,
    include: str | Iterable[str] | None = None,
    exclude: str | Iterable[str] | None = None,
    column: str = "schema_name",
) -> DataFrame:
    """Exact, case-sensitive names: those included (all when none are named) minus those excluded."""
    include, exclude = parse_list(include), parse_list(exclude)
    if include:
        schemas = schemas.filter(F.col(column).isin(include))
    if exclude:
        schemas = schemas.filter(~F.col(column).isin(exclude))
    return schemas


def schema_set(
    spark: SparkSession,
    schemas: DataFrame,
    include: Iterable[str] | None = None,
    exclude: Iterable[str] | None = None,
) -> DataFrame:
    """The same choice over distinct names as set operations: (schemas ∩ include) − exclude."""
    names = schemas.select("schema_name")
    if include := parse_list(include):
        names = names.intersect(spark.createDataFrame([(n,) for n in include], "schema_name string"))
    if exclude := parse_list(exclude):
        names = names.subtract(spark.createDataFrame([(n,) for n in exclude], "schema_name string"))
    return names


def select_tables(
    tables: DataFrame,
    include: str | Iterable[str] | None = None,
    exclude: str | Iterable[str] | None = None,
) -> DataFrame:
    """Wildcard patterns on `schema_name`, `table_name`: include first, then exclude."""
    schema, table = F.col("schema_name"), F.col("table_name")
    include, exclude = parse_list(include), parse_list(exclude)
    if include:
        tables = tables.filter(matches_any(schema, table, include))
    if exclude:
        tables = tables.filter(~matches_any(schema, table, exclude))
    return tables
