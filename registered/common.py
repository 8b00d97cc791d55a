"""Shared by the registered queries: table access and the data sets derived from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.names import manifest_name
from tidemark.functions.stamps import stamp_column
from tidemark.sources.manifests import with_tokens

Query = Callable[[SparkSession, str], DataFrame]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[query.__name__] = query
            if sql is not None:
                self.oracles[query.__name__] = sql
            return query

        return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counts_sql(names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in names
    )


# The columns of the test tables and how their values are summed up: integers and texts by hash,
# numbers by ten-thousandths, moments by hash of their digits, vectors by 2^-20ths of their elements.
COLUMNS = {
    "region": "r_regionkey:hash r_name:hash",
    "nation": "n_nationkey:hash n_name:hash n_regionkey:hash",
    "customer": "c_custkey:hash c_name:hash c_nationkey:hash c_acctbal:number c_mktsegment:hash",
    "supplier": "s_suppkey:hash s_name:hash s_nationkey:hash s_acctbal:number",
    "part": "p_partkey:hash p_name:hash p_brand:hash p_type:hash p_size:hash p_retailprice:number",
    "orders": "o_orderkey:hash o_custkey:hash o_orderstatus:hash o_totalprice:number o_orderdate:moment o_orderpriority:hash",
    "lineitem": "l_orderkey:hash l_partkey:hash l_suppkey:hash l_linenumber:hash l_quantity:number l_extendedprice:number "
    "l_discount:number l_tax:number l_returnflag:hash l_linestatus:hash l_shipdate:moment",
    "events": "event_id:hash ts:moment user_id:hash event_type:hash value:number props:hash",
    "documents": "doc_id:hash text:hash lang:hash source:hash n_chars:hash",
    "embeddings": "vec_id:hash embedding:vector label:hash",
    "pages": "page_id:hash url:hash html:hash",
    "benchmark": "item_id:hash text:hash",
    "labels": "doc_id:hash quality:hash toxic:hash",
    "conversations": "conv_id:hash turn:hash role:hash text:hash",
}
_SUMS_SQL = {
    "hash": "('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8))::BIGINT",
    "number": "CAST(floor({c} * 10000 + 0.5) AS BIGINT)",
    "moment": "('0x' || substr(md5(strftime({c}, '%Y%m%d%H%M%S%f')), 1, 8))::BIGINT",
    "vector": "list_sum(list_transform({c}, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1048576) AS BIGINT)))",
}


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in COLUMNS[table].split()]


def column_sums_sql(tables: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values,"
        f" CAST(coalesce(sum({_SUMS_SQL[kind].format(c=c)}), 0) AS BIGINT) AS check_sum FROM {t}"
        for t in tables for c, kind in _columns(t)
    )


def column_sums(table: str, df: DataFrame) -> DataFrame:
    """One row for each column: rows, values that are not null, and a sum over all of them."""
    def hashed(text):
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")

    def summed(c: str, kind: str):
        if kind == "hash":
            return hashed(F.col(c).cast("string"))
        if kind == "number":
            return F.floor(F.col(c) * 10000 + 0.5).cast("bigint")
        if kind == "moment":
            return hashed(F.date_format(c, "yyyyMMddHHmmssSSSSSS"))
        return F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + F.floor(x.cast("double") * 1048576).cast("bigint"))

    columns = _columns(table)
    if [c for c, _ in columns] != df.columns:
        raise ValueError(f"{table} has other columns than expected: {df.columns}")
    row = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c, _ in columns],
        *[F.coalesce(F.sum(summed(c, kind)), F.lit(0)).alias(f"s_{c}") for c, kind in columns],
    )
    each = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("n_values"), F.col(f"s_{c}").cast("bigint").alias("check_sum"))
        for c, _ in columns
    ])
    return row.select(F.lit(table).alias("table_name"), "n_rows", F.inline(each))


# The event stream as a change log: files 8, 9, 10, ... of 1,000 events; errors delete their user.
CHANGES_SQL = """
    SELECT 'mysql-bin.' || (8 + event_id // 1000) AS file, 8 + event_id // 1000 AS seq,
           4 + (event_id % 1000) * 100 AS pos,
           CASE WHEN event_type = 'error' THEN 'delete' ELSE 'write' END AS op,
           user_id, event_id, event_type, value
    FROM events
"""


def change_log(events: DataFrame) -> DataFrame:
    number = F.expr("8 + event_id div 1000")
    return events.select(
        F.concat(F.lit("mysql-bin."), number).alias("file"),
        (4 + F.col("event_id") % 1000 * 100).alias("pos"),
        F.when(F.col("event_type") == "error", "delete").otherwise("write").alias("op"),
        "user_id", "event_id", "event_type", "value",
    )


# The event stream as manifests of 15 families: one set per event type, mode and second.
MANIFESTS_SQL = """
    SELECT DISTINCT 's3' AS destination, event_type AS database, 'pgsql' AS driver, mode,
           strftime(ts, '%Y%m%d_%H%M%S') AS set_token, strftime(ts, '%Y%m%d_%H%M%S') AS set_ts,
           event_type || '_pg_' || mode || '_' || strftime(ts, '%Y%m%d_%H%M%S')
               || '.manifest.json' AS manifest
    FROM (SELECT *, CASE user_id % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'schema'
                    ELSE 'incremental' END AS mode FROM events)
"""


def mode_of(events: DataFrame) -> DataFrame:
    third = F.col("user_id") % 3
    return events.withColumn(
        "mode", F.when(third == 0, "full").when(third == 1, "schema").otherwise("incremental")
    )


def manifest_set(events: DataFrame) -> DataFrame:
    named = mode_of(events).select(
        F.lit("s3").alias("destination"),
        F.col("event_type").alias("database"),
        F.lit("pgsql").alias("driver"),
        "mode",
        manifest_name(
            F.col("event_type"), F.lit("pgsql"), F.col("mode"), stamp_column(F.col("ts"))
        ).alias("manifest"),
    )
    return with_tokens(named.distinct())
