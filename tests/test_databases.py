"""Queries and options for databases, without one: a stand-in for the reader gives the catalog's rows."""

from __future__ import annotations

import duckdb
import pytest

from tidemark.sources import databases as db
from tidemark.sources.catalog import CATALOG_SCHEMA, watermark_tables


def test_names_are_quoted():
    assert db.quoted("pgsql", "public", "Order") == '"public"."Order"'
    assert db.quoted("pgsql", 'a"; DROP TABLE x; --') == '"a""; DROP TABLE x; --"'
    assert db.quoted("mysql", "a`b", "c.d") == "`a``b`.`c.d`"
    assert db.literal("pgsql", "it's \\") == "'it''s \\'" and db.literal("mysql", "it's \\") == "'it''s \\\\'"
    for call in (db.quoted, db.literal):
        with pytest.raises(ValueError, match="zero"):
            call("pgsql", "a\0b")
    with pytest.raises(KeyError):
        db.quoted("oracle", "a")


def test_table_options():
    got = db.table_options("jdbc:x", "pgsql", "a", "t", partition_column="Id", bounds=(0, 99), num_partitions=4, properties={"user": "u", "url": "other"})
    assert got == {
        "user": "u", "url": "jdbc:x", "dbtable": '"a"."t"', "fetchsize": "10000", "partitionColumn": '"Id"',
        "lowerBound": "0", "upperBound": "99", "numPartitions": "4",
    }
    with pytest.raises(ValueError, match="bounds"):
        db.table_options("jdbc:x", "pgsql", "a", "t", partition_column="id")


def catalog_of(query):
    """The query, run by DuckDB on a catalog of its own."""
    con = duckdb.connect()
    for statement in (
        "CREATE SCHEMA sales", "CREATE SCHEMA audit", "CREATE TABLE sales.orders (id INT NOT NULL, updated_at TIMESTAMP)",
        "CREATE TABLE sales.lines (id INT, n INT)", "CREATE VIEW sales.v AS SELECT * FROM sales.orders", "CREATE TABLE audit.log (id INT, updated_at DATE)",
    ):
        con.execute(statement)
    return con.execute(query).fetchall()


def test_the_database_filters_the_catalog():
    def tables(**filters):
        return sorted({(r[0], r[1]) for r in catalog_of(db.catalog_query("pgsql", **filters))})
    assert tables() == [("audit", "log"), ("sales", "lines"), ("sales", "orders")]
    assert tables(views=True) == [("audit", "log"), ("sales", "lines"), ("sales", "orders"), ("sales", "v")]
    assert tables(watermark="updated_at") == [("audit", "log"), ("sales", "orders")]
    assert tables(schemas=["sales"]) == [("sales", "lines"), ("sales", "orders")]
    assert tables(schemas=["sales", "audit"], exclude_schemas=["sales"]) == [("audit", "log")]
    assert tables(schemas=[]) == [] and tables(schemas=["it's"]) == []
    assert [r[2:] for r in catalog_of(db.catalog_query("mysql", schemas=["sales"], watermark="updated_at"))] == [
        ("TABLE", 1, "id", "INTEGER", 0), ("TABLE", 2, "updated_at", "TIMESTAMP", 1)
    ]


def test_a_table_set_from_the_catalog(spark):
    asked = []

    def load(options):
        asked.append(options)
        if "query" in options:
            rows = catalog_of(options["query"])
            return spark.createDataFrame(rows, "schema_name string, table_name string, kind string, ordinal bigint, column_name string, data_type string, nullable int")
        return spark.range(3)

    catalog = db.database_catalog(spark, "jdbc:x", "pgsql", load=load)
    assert catalog.schema.simpleString() == spark.createDataFrame([], CATALOG_SCHEMA).schema.simpleString()
    assert [(r.schema_name, r.table_name) for r in watermark_tables(catalog, "updated_at").collect()] == [("audit", "log"), ("sales", "orders")]
    found = db.database_tables(
        spark, "jdbc:x", "pgsql", include="sales.*", exclude="lines", views=True, load=load, ranges={"sales.orders": ("id", 1, 9, 2)}
    )
    assert [(t.name, t.kind, t.df.count()) for t in found] == [("sales.orders", "TABLE", 3), ("sales.v", "VIEW", 3)]
    assert [o.get("dbtable") for o in asked[-2:]] == ['"sales"."orders"', '"sales"."v"'] and asked[-2]["partitionColumn"] == '"id"'
    assert db.jdbc_table(spark, "jdbc:x", "mysql", "a`b", "t", load=load).name == "a`b.t" and asked[-1]["dbtable"] == "`a``b`.`t`"
