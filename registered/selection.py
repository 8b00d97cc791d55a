"""Catalogs, schema and table filters, option texts, placement."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.common import TABLES, Registry, counts_sql, load
from tidemark.functions.names import (
    artifact_path,
    basename,
    canonical_driver,
    driver_abbreviation,
    set_token,
    set_ts,
)
from tidemark.functions.options import base_path, destination_map, non_negative_int
from tidemark.functions.stamps import stamp_column
from tidemark.operators.incremental import extract_summary
from tidemark.operators.placement import placement_plan
from tidemark.operators.selection import schema_set, select_schemas, select_tables
from tidemark.sources.catalog import catalog_columns as columns_of
from tidemark.sources.catalog import table_counts, user_schemas, user_tables, watermark_columns
from tidemark.sources.tables import TABLE, VIEW, Table, find_table, parquet_tables

R = Registry()
NAMES = ", ".join(f"'{t}'" for t in TABLES)


@R.add(f"""
    SELECT 'main' AS schema_name, c.table_name, c.ordinal_position AS ordinal, c.column_name,
           CASE c.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                END AS data_type, n.n_rows
    FROM information_schema.columns c JOIN ({counts_sql(TABLES)}) n ON n.table_name = c.table_name
    WHERE c.table_schema = 'main'
""")
def catalog_columns(spark, sf_dir):
    """The schema snapshot of all tables, with the rows each holds."""
    tables = parquet_tables(spark, sf_dir, TABLES)
    return (
        columns_of(spark, tables)
        .join(table_counts(tables), ["schema_name", "table_name"])
        .select("schema_name", "table_name", "ordinal", "column_name", "data_type", "n_rows")
    )


@R.add("""
    SELECT 'events' AS table_name, 'ts' AS column_name, count(*) AS n_rows,
           max(ts) AS max_watermark FROM events
    UNION ALL SELECT 'lineitem', 'l_shipdate', count(*), max(l_shipdate) FROM lineitem
    UNION ALL SELECT 'orders', 'o_orderdate', count(*), max(o_orderdate) FROM orders
""")
def watermark_tables(spark, sf_dir):
    """Tables that can be extracted by watermark, with their rows and highest watermark."""
    tables = parquet_tables(spark, sf_dir, TABLES)
    found = watermark_columns(columns_of(spark, tables)).collect()
    columns = {r.table_name: r.column_name for r in found}
    summary = extract_summary(
        {r.table_name: (find_table(tables, "main", r.table_name).df, r.column_name) for r in found}
    )
    name_of = F.create_map(*[F.lit(x) for item in columns.items() for x in item])
    return summary.select(
        "table_name", name_of[F.col("table_name")].alias("column_name"), "n_rows", "max_watermark"
    )


@R.add(f"""
    SELECT * FROM ({counts_sql(TABLES)})
    WHERE (regexp_matches(table_name, '^.*s$', 'i') OR regexp_matches(table_name, '^.*item$', 'i'))
      AND NOT (regexp_matches(table_name, '^orders$', 'i') OR regexp_matches(table_name, '^p.*$', 'i'))
""")
def table_filter(spark, sf_dir):
    """Include `*.*s` and `main.*item`, exclude `ORDERS` and `main.P*`: a snapshot of the rest."""
    tables = parquet_tables(spark, sf_dir, TABLES)
    chosen = select_tables(
        user_tables(columns_of(spark, tables)), "*.*s,main.*item", "ORDERS,main.P*"
    )
    names = [r.table_name for r in chosen.collect()]
    return table_counts([find_table(tables, "main", n) for n in names]).select("table_name", "n_rows")


@R.add("""
    SELECT c_mktsegment AS schema_name, count(*) AS n_rows FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AND c_mktsegment NOT IN ('MACHINERY')
    GROUP BY 1
""")
def schema_filter(spark, sf_dir):
    rows = load(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "schema_name")
    chosen = select_schemas(rows, "BUILDING, MACHINERY, HOUSEHOLD, building", "MACHINERY")
    return chosen.groupBy("schema_name").agg(F.count(F.lit(1)).alias("n_rows"))


@R.add("""
    (SELECT c_mktsegment AS schema_name FROM customer
     INTERSECT SELECT * FROM (VALUES ('BUILDING'), ('MACHINERY'), ('HOUSEHOLD'), ('none')))
    EXCEPT SELECT * FROM (VALUES ('MACHINERY'))
""")
def schema_set_operations(spark, sf_dir):
    names = load(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("schema_name"))
    return schema_set(spark, names, ["BUILDING", "MACHINERY", "HOUSEHOLD", "none"], ["MACHINERY"])


@R.add("""
    SELECT name AS manifest, nullif(regexp_extract(name,
               '_(\\d{8}_\\d{6}(?:_[A-Za-z0-9._-]+)?)\\.manifest\\.json$', 1), '') AS set_token,
           substring(nullif(regexp_extract(name,
               '_(\\d{8}_\\d{6}(?:_[A-Za-z0-9._-]+)?)\\.manifest\\.json$', 1), ''), 1, 15) AS set_ts
    FROM (SELECT 'shop_20200101_000000_pg_full_' || strftime(o_orderdate, '%Y%m%d_%H%M%S')
                 || CASE WHEN o_orderkey % 3 = 0 THEN '_n' || o_orderkey ELSE '' END
                 || CASE WHEN o_orderkey % 7 = 0 THEN '.json' ELSE '.manifest.json' END AS name
          FROM orders WHERE o_orderkey % 2 = 0
          UNION ALL
          SELECT 'shop_my_full_' || strftime(o_orderdate, '%Y%m%d_%H%M%S')
                 || CASE WHEN o_orderkey % 3 = 0 THEN '_n' || o_orderkey ELSE '' END
                 || CASE WHEN o_orderkey % 7 = 0 THEN '.json' ELSE '.manifest.json' END
          FROM orders WHERE o_orderkey % 2 = 1)
""")
def manifest_tokens(spark, sf_dir):
    """Tokens out of names, with notes, names that have none and a database named like a stamp."""
    key = F.col("o_orderkey")
    names = load(spark, sf_dir, "orders").select(
        F.concat(
            F.when(key % 2 == 0, "shop_20200101_000000_pg_full_").otherwise("shop_my_full_"),
            stamp_column(F.col("o_orderdate")),
            F.when(key % 3 == 0, F.concat(F.lit("_n"), key)).otherwise(""),
            F.when(key % 7 == 0, ".json").otherwise(".manifest.json"),
        ).alias("manifest")
    )
    token = set_token(F.col("manifest"))
    return names.select("manifest", token.alias("set_token"), set_ts(token).alias("set_ts"))


@R.add("""
    SELECT o_orderkey, 'arc/' || o_orderstatus AS near, '' AS far,
           o_orderpriority AS vault, 'spare/y' AS tape
    FROM orders
""")
def destination_options(spark, sf_dir):
    """Option texts parsed per row: trimmed slashes, an empty path, a pair without colon, a fallback."""
    text = F.concat(
        F.lit("near:/arc/"), "o_orderstatus", F.lit("/, far: ,junk,,vault:/"), "o_orderpriority"
    )
    mapped = load(spark, sf_dir, "orders").select("o_orderkey", destination_map(text).alias("m"))
    return mapped.select(
        "o_orderkey",
        *[
            base_path(F.lit(d), F.col("m"), F.lit("spare/y/")).alias(d)
            for d in ("near", "far", "vault", "tape")
        ],
    )


@R.add("""
    SELECT o_orderkey, o_orderstatus || '/a:b' AS near, '' AS far, 'spare' AS vault,
           CASE o_orderkey % 3 WHEN 0 THEN 'mysql' WHEN 1 THEN 'mysql' ELSE 'pgsql' END AS driver,
           CASE o_orderkey % 3 WHEN 2 THEN 'pg' ELSE 'my' END AS short,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS keep
    FROM orders
""")
def run_options(spark, sf_dir):
    """Destination maps as JSON, drivers in any case and by their other name, counts with blanks."""
    orders, key = load(spark, sf_dir, "orders"), F.col("o_orderkey")
    mapped = orders.withColumns({
        "m": destination_map(F.concat(F.lit(' {"near": "/'), "o_orderstatus", F.lit('/a:b/", "far": null}'))),
        "driver": F.when(key % 3 == 0, "MySQL").when(key % 3 == 1, "MariaDB").otherwise("PgSQL"),
        "count": F.when(key % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "o_custkey", F.lit("\t"))),
    })
    return mapped.select(
        "o_orderkey", *[base_path(F.lit(d), F.col("m"), F.lit("/spare/")).alias(d) for d in ("near", "far", "vault")],
        canonical_driver(F.col("driver")).alias("driver"), driver_abbreviation(F.col("driver")).alias("short"),
        non_negative_int(F.col("count")).alias("keep"),
    )


@R.add("""
    SELECT schema_name, table_name, n_rows, CAST(row_number() OVER (ORDER BY schema_name, table_name) AS BIGINT) AS place FROM (
        SELECT CASE WHEN substr(table_name, 1, 1) < 'l' THEN 'audit' ELSE 'sales' END AS schema_name, table_name, n_rows
        FROM (%s) WHERE table_name NOT IN ('region', 'nation', 'pages')
    )
""" % counts_sql(TABLES))
def user_catalog(spark, sf_dir):
    """Schemas and ordinary tables of a catalog that holds system schemas and a view too, in order."""
    def schema(name: str) -> str:
        return {"region": "pg_catalog", "nation": "information_schema"}.get(name, "audit" if name[0] < "l" else "sales")

    tables = [Table(schema(t), t, load(spark, sf_dir, t), VIEW if t == "pages" else TABLE) for t in TABLES]
    catalog = columns_of(spark, tables)
    names = user_tables(catalog).join(user_schemas(catalog), "schema_name", "left_semi").orderBy("schema_name", "table_name").collect()
    places = spark.createDataFrame([(*n, k) for k, n in enumerate(names, 1)], "schema_name string, table_name string, place bigint")
    counts = table_counts([find_table(tables, *n) for n in names])
    return counts.join(places, ["schema_name", "table_name"]).select("schema_name", "table_name", "n_rows", "place")


@R.add("""
    SELECT event_id, disk, base_path, file_name,
           CASE WHEN base_path = '' THEN path ELSE base_path || '/' || path END AS remote_path
    FROM (SELECT event_id, event_type || '/incremental/public/user-' || user_id || '/set='
                 || strftime(ts, '%Y%m%d_%H%M%S') AS path,
                 'set=' || strftime(ts, '%Y%m%d_%H%M%S') AS file_name FROM events),
         (VALUES ('near', 'arc/one'), ('far', ''), ('vault', 'spare/y')) d(disk, base_path)
""")
def placement(spark, sf_dir):
    """Every artifact at three destinations: one mapped, one mapped to its root, one falling back."""
    path = artifact_path(
        F.col("event_type"), F.lit("incremental"), stamp_column(F.col("ts")),
        F.lit("public"), F.concat(F.lit("user "), "user_id"),
    )
    artifacts = load(spark, sf_dir, "events").select("event_id", path.alias("path"))
    plan = placement_plan(artifacts, ["near", "far", "vault"], "near:/arc/one/,far:", "spare/y")
    return plan.select(
        "event_id", "disk", "base_path", basename(F.col("path")).alias("file_name"), "remote_path"
    )
