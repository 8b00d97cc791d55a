"""A database's catalog and tables over JDBC, with what can be decided there decided there.

The catalog is one query that the database runs: schema, watermark and kind filters are part of its
text, so only columns of wanted tables come back. Names are quoted by the dialect's rules wherever they
become part of a query, and values are written as literals of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.selection import select_tables
from tidemark.sources.catalog import CATALOG_SCHEMA, SYSTEM_SCHEMAS
from tidemark.sources.tables import TABLE, VIEW, Table

PGSQL, MYSQL = "pgsql", "mysql"
QUOTES = {PGSQL: '"', MYSQL: "`"}
# Schemas that the two servers keep for themselves.
SERVER_SCHEMAS = {PGSQL: SYSTEM_SCHEMAS, MYSQL: ["information_schema", "mysql", "performance_schema", "sys"]}


def quoted(dialect: str, *names: str) -> str:
    """A name of one or more parts, each in quotes, with quotes inside doubled."""
    mark = QUOTES[dialect]
    if any("\0" in n for n in names):
        raise ValueError("a name holds a zero character")
    return ".".join(mark + n.replace(mark, mark * 2) + mark for n in names)


def literal(dialect: str, value: str) -> str:
    """A text value. MySQL takes a backslash for an escape, PostgreSQL does not."""
    if "\0" in value:
        raise ValueError("a value holds a zero character")
    value = value.replace("'", "''")
    return "'" + (value.replace("\\", "\\\\") if dialect == MYSQL else value) + "'"


def catalog_query(
    dialect: str, *, schemas: Sequence[str] | None = None, exclude_schemas: Sequence[str] = (),
    watermark: str | None = None, views: bool = False,
) -> str:
    """The query for the columns of all tables outside the server's schemas, or of those wanted: with
    `watermark` of tables that have a column of that name."""
    def names(values: Iterable[str]) -> str:
        return ", ".join(literal(dialect, v) for v in values)

    where = [f"t.table_schema NOT IN ({names([*SERVER_SCHEMAS[dialect], *exclude_schemas])})"]
    if schemas is not None:
        where.append(f"t.table_schema IN ({names(schemas)})" if schemas else "1 = 0")
    where.append("t.table_type IN ('BASE TABLE', 'VIEW')" if views else "t.table_type = 'BASE TABLE'")
    if watermark is not None:
        where.append(
            "EXISTS (SELECT 1 FROM information_schema.columns w WHERE w.table_schema = t.table_schema"
            f" AND w.table_name = t.table_name AND w.column_name = {literal(dialect, watermark)})"
        )
    return (
        "SELECT c.table_schema AS schema_name, c.table_name AS table_name,"
        f" CASE t.table_type WHEN 'VIEW' THEN '{VIEW}' ELSE '{TABLE}' END AS kind,"
        " c.ordinal_position AS ordinal, c.column_name AS column_name, c.data_type AS data_type,"
        " CASE c.is_nullable WHEN 'YES' THEN 1 ELSE 0 END AS nullable"
        " FROM information_schema.columns c JOIN information_schema.tables t"
        " ON t.table_schema = c.table_schema AND t.table_name = c.table_name"
        f" WHERE {' AND '.join(where)}"
    )


def catalog_options(url: str, dialect: str, properties: Mapping[str, str] | None = None, **filters) -> dict[str, str]:
    """What Spark's reader is given for the catalog. `query` and `dbtable` exclude each other."""
    return {**(properties or {}), "url": url, "query": catalog_query(dialect, **filters)}


def table_options(
    url: str, dialect: str, schema_name: str, table_name: str, *, partition_column: str | None = None,
    bounds: tuple[object, object] | None = None, num_partitions: int | None = None,
    fetch_size: int = 10_000, properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """What Spark's reader is given for one table: parallel ranges of `partition_column` if it is named.
    The bounds only place the ranges: rows outside them are read too."""
    options = {**(properties or {}), "url": url, "dbtable": quoted(dialect, schema_name, table_name), "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("partition_column needs bounds and num_partitions")
        options |= {
            "partitionColumn": quoted(dialect, partition_column), "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]), "numPartitions": str(num_partitions),
        }
    return options


Load = Callable[[dict[str, str]], DataFrame]


def _jdbc(spark: SparkSession) -> Load:
    return lambda options: spark.read.format("jdbc").options(**options).load()


def database_catalog(
    spark: SparkSession, url: str, dialect: str, *, properties: Mapping[str, str] | None = None, load: Load | None = None, **filters
) -> DataFrame:
    """The catalog as a relation of the columns that `catalog_columns` has; filters as in `catalog_query`."""
    rows = (load or _jdbc(spark))(catalog_options(url, dialect, properties, **filters))
    kinds = dict(c.rsplit(" ", 1) for c in CATALOG_SCHEMA.split(", "))
    return rows.select(*[F.col(n).cast(k).alias(n) for n, k in kinds.items()])


def database_tables(
    spark: SparkSession, url: str, dialect: str, *, include: str | Iterable[str] | None = None,
    exclude: str | Iterable[str] | None = None, ranges: Mapping[str, tuple[str, object, object, int]] | None = None,
    properties: Mapping[str, str] | None = None, load: Load | None = None, **filters,
) -> list[Table]:
    """The table set of a database: one entry for each table of its catalog that passes the filters.

    `ranges` gives, by `schema.table`, a column with its bounds and number of ranges to read in parallel.
    Nothing but the catalog is read before a table's rows are asked for.
    """
    reader = load or _jdbc(spark)
    catalog = database_catalog(spark, url, dialect, properties=properties, load=load, **filters)
    kinds = catalog.select("schema_name", "table_name", "kind").distinct()
    chosen = select_tables(kinds, include, exclude).orderBy("schema_name", "table_name").collect()
    out = []
    for r in chosen:
        column, low, high, n = (ranges or {}).get(f"{r.schema_name}.{r.table_name}", (None, None, None, None))
        options = table_options(
            url, dialect, r.schema_name, r.table_name, partition_column=column,
            bounds=None if column is None else (low, high), num_partitions=n, properties=properties,
        )
        out.append(Table(r.schema_name, r.table_name, reader(options), r.kind))
    return out


def jdbc_table(spark: SparkSession, url: str, dialect: str, schema_name: str, table_name: str, *, load: Load | None = None, **options) -> Table:
    """One table by its name; options as in `table_options`. Filters on the result, the watermark filter
    among them, are pushed into the database by Spark."""
    return Table(schema_name, table_name, (load or _jdbc(spark))(table_options(url, dialect, schema_name, table_name, **options)))
