"""Upserts and whole backup chains, restored."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from registered.changes import REPLAY_SQL
from registered.common import TABLES, Registry, change_log, load
from tidemark.operators.changes import replay, with_seq
from tidemark.operators.restore import upsert, upsert_partitions
from tidemark.plans.backup import run_backup
from tidemark.plans.restore import restore_schema, restore_set, restore_table, upsert_in_place
from tidemark.sinks.formats import CSV, read_artifact, write_artifact
from tidemark.sources.catalog import catalog_columns, table_counts
from tidemark.sources.manifests import parsed_meta
from tidemark.sources.tables import Table, table_set
from tidemark.workspace import work_dir

R = Registry()


def _increment(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderkey") % 10 == 0).withColumn("o_orderstatus", F.lit("X"))


@R.add("""
    SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '1997-01-01' AND o_orderkey % 10 <> 0
    UNION ALL
    SELECT * REPLACE ('X' AS o_orderstatus) FROM orders WHERE o_orderkey % 10 = 0
""")
def upsert_orders(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    base = orders.filter("o_orderdate <= TIMESTAMP_NTZ '1997-01-01'")
    return upsert(base, _increment(orders), ["o_orderkey"])


@R.add("""
    SELECT * FROM customer WHERE c_custkey % 4 <> 0
    UNION ALL
    SELECT * REPLACE (c_acctbal + 1 AS c_acctbal) FROM customer WHERE c_custkey % 4 = 0
""")
def upsert_from_csv(spark, sf_dir):
    """An increment kept as compressed CSV, loaded with its declared columns and upserted."""
    customer = load(spark, sf_dir, "customer")
    changed = customer.filter("c_custkey % 4 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    path = work_dir(spark, "staging")
    write_artifact(changed, path, fmt=CSV, compression="gzip")
    staging = read_artifact(spark, path, customer.schema, fmt=CSV)
    return upsert(customer, staging, ["c_custkey"])


@R.add("""
    SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
    FROM orders
    WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders
                              WHERE o_orderkey % 10 = 0 AND o_orderpriority <> '5-LOW')
      AND o_orderpriority <> '5-LOW'
""")
def upsert_touched_partitions(spark, sf_dir):
    """Only partitions that the increment touches are rebuilt; the rest is neither read nor written."""
    orders = load(spark, sf_dir, "orders")
    path = work_dir(spark, "by-priority")
    write_artifact(orders, path, partition_by=("o_orderpriority",))
    increment = _increment(orders).filter("o_orderpriority <> '5-LOW'")
    return upsert_partitions(
        read_artifact(spark, path, orders.schema), increment, ["o_orderpriority", "o_orderkey"], ["o_orderpriority"]
    )


@R.add("""
    WITH o AS (SELECT *, o_custkey % 500 AS shard FROM orders),
         touched AS (SELECT DISTINCT shard FROM o WHERE o_orderkey % 10 = 0 AND (shard < 40 OR shard > 460) AND shard % 3 = 0)
    SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
    FROM o WHERE shard IN (SELECT shard FROM touched)
""")
def upsert_scattered_partitions(spark, sf_dir):
    """A table in some 500 partitions and an increment that touches a few at both ends: the scan is pruned
    to these when it runs, not to all between the least and the greatest."""
    orders = load(spark, sf_dir, "orders").withColumn("shard", F.col("o_custkey") % 500)
    path = work_dir(spark, "by-shard")
    write_artifact(orders.repartition("shard"), path, partition_by=("shard",))
    increment = _increment(orders).filter("(shard < 40 OR shard > 460) AND shard % 3 = 0")
    return upsert_partitions(read_artifact(spark, path, orders.schema), increment, ["shard", "o_orderkey"], ["shard"])


@R.add("""
    SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 AND o_orderpriority <> '5-LOW' THEN 'X'
                      ELSE o_orderstatus END AS o_orderstatus)
    FROM orders
""")
def upsert_in_stored_table(spark, sf_dir):
    """A table stored by priority, an increment that leaves one priority alone, upserted in place."""
    orders = load(spark, sf_dir, "orders")
    path = work_dir(spark, "in-place")
    write_artifact(orders, path, partition_by=("o_orderpriority",))
    increment = _increment(orders).filter("o_orderpriority <> '5-LOW'")
    upsert_in_place(
        path, orders.schema, increment, ["o_orderpriority", "o_orderkey"], ["o_orderpriority"]
    )
    return read_artifact(spark, path, orders.schema)


T0, T1, T2 = "1997-01-01", "1999-01-01", "2001-01-01"


def _orders_at(orders: DataFrame, when: str) -> DataFrame:
    """The orders table at three instants: rows arrive over time and some are updated in between."""
    seen = orders.filter(f"o_orderdate <= TIMESTAMP_NTZ '{when}'")
    ten = F.expr("o_orderkey % 10 = 0 AND o_orderdate <= TIMESTAMP_NTZ '1998-06-01'") & F.lit(when >= T1)
    seven = F.expr("o_orderkey % 7 = 0 AND o_orderdate <= TIMESTAMP_NTZ '2000-06-01'") & F.lit(when >= T2)
    return seen.withColumns({
        "o_orderstatus": F.when(seven, "Y").when(ten, "X").otherwise(F.col("o_orderstatus")),
        "updated_at": F.when(seven, F.expr("TIMESTAMP_NTZ '2000-06-01'"))
        .when(ten, F.expr("TIMESTAMP_NTZ '1998-06-01'")).otherwise(F.col("o_orderdate")),
    })


def _chain_sql(until: str) -> str:
    ten = "o_orderkey % 10 = 0 AND o_orderdate <= TIMESTAMP '1998-06-01'"
    seven = f"o_orderkey % 7 = 0 AND o_orderdate <= TIMESTAMP '2000-06-01' AND '{until}' >= '{T2}'"
    return f"""
        SELECT * REPLACE (CASE WHEN {seven} THEN 'Y' WHEN {ten} THEN 'X' ELSE o_orderstatus END
                          AS o_orderstatus),
               CASE WHEN {seven} THEN TIMESTAMP '2000-06-01' WHEN {ten} THEN TIMESTAMP '1998-06-01'
                    ELSE o_orderdate END AS updated_at
        FROM orders WHERE o_orderdate <= TIMESTAMP '{until}'
    """


def _orders_chain(spark, sf_dir: str, until: str) -> DataFrame:
    base = work_dir(spark, "chain")
    orders = load(spark, sf_dir, "orders")
    for when, mode in ((T0, "full"), (T1, "incremental"), (T2, "incremental")):
        run_backup(
            spark, [Table("public", "orders", _orders_at(orders, when))], database="shop",
            destinations={"local": base}, mode=mode, at=when,
        )
    return restore_table(spark, base, "shop", "public", "orders", ["o_orderkey"], until=until)


@R.add(_chain_sql(T2))
def restore_chain(spark, sf_dir):
    """A full backup, two increments (the first from the full set on, the second from saved state), and
    the restored table."""
    return _orders_chain(spark, sf_dir, T2)


@R.add(_chain_sql(T1))
def restore_point_in_time(spark, sf_dir):
    """The same chain, restored to the instant of the first increment."""
    return _orders_chain(spark, sf_dir, T1)


@R.add(f"""
    SELECT o.*, c.*, s.* FROM ({_chain_sql(T2)}) o
    JOIN (SELECT * REPLACE (CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal),
                 CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '1996-01-01' END AS c_updated
          FROM customer) c ON o.o_custkey = c.c_custkey
    LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey
""")
def restore_all_tables(spark, sf_dir):
    """Three tables backed up in full and twice in part, restored as one set; two of them changed."""
    base = work_dir(spark, "whole-set")
    orders, customer, supplier = (load(spark, sf_dir, n) for n in ("orders", "customer", "supplier"))
    for when, mode in ((T0, "full"), (T1, "incremental"), (T2, "incremental")):
        changed = F.lit(when >= T1) & (F.col("c_custkey") % 4 == 0)
        customers = customer.withColumns({
            "c_acctbal": F.when(changed, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")),
            "updated_at": F.when(changed, F.expr("TIMESTAMP_NTZ '1998-01-01'")).otherwise(F.expr("TIMESTAMP_NTZ '1996-01-01'")),
        })
        tables = {"public.orders": _orders_at(orders, when), "public.customer": customers, "ref.supplier": supplier}
        run_backup(spark, table_set(tables), database="shop", destinations={"local": base}, mode=mode, at=when)
    back = restore_set(
        spark, base, "shop", {"public.orders": ["o_orderkey"], "public.customer": ["c_custkey"]}, until=T2
    )
    customers = back["public.customer"].withColumnRenamed("updated_at", "c_updated")
    joined = back["public.orders"].join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.join(back["ref.supplier"], F.col("s_suppkey") == F.col("c_custkey"), "left")


@R.add("""
    SELECT c.table_name, c.ordinal_position AS ordinal, c.column_name,
           CASE c.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type,
           CASE WHEN c.table_name IN ('orders', 'lineitem', 'part') THEN 'sales' ELSE 'main' END AS schema_name
    FROM information_schema.columns c
    WHERE c.table_schema = 'main' AND c.table_name NOT IN ('region', 'nation')
""")
def restore_schema_only(spark, sf_dir):
    """A schema set of two schemas, found by its manifest and rebuilt as empty tables."""
    base = work_dir(spark, "schema-only")
    tables = [
        Table("sales" if t in ("orders", "lineitem", "part") else "lookup" if t in ("region", "nation") else "main", t, load(spark, sf_dir, t))
        for t in TABLES
    ]
    run_backup(
        spark, tables, database="shop", destinations={"local": base}, mode="schema", at=T0, per_schema=True, exclude_schemas="lookup"
    )
    rebuilt = restore_schema(spark, base, "shop", until=T1)
    restored = [Table(*name.split("."), df) for name, df in rebuilt.items()]
    found = catalog_columns(spark, restored).join(table_counts(restored).filter("n_rows = 0"), ["schema_name", "table_name"])
    return found.select("table_name", "ordinal", "column_name", "data_type", "schema_name")


@R.add(f"SELECT user_id, event_id, event_type, value FROM ({REPLAY_SQL})")
def restore_log_chain(spark, sf_dir):
    """A full backup in the middle of a change log, two log increments, and the restored table."""
    base = work_dir(spark, "log-chain")
    log = with_seq(change_log(load(spark, sf_dir, "events")))
    last = log.agg(F.max("event_id").alias("n")).first().n
    columns = ["user_id", "event_id", "event_type", "value"]
    for at, mode, upto in (
        ("2024-02-01", "full", last // 3),
        ("2024-02-02", "incremental", 2 * last // 3),
        ("2024-02-03", "incremental", last),
    ):
        seen = log.filter(F.col("event_id") <= upto)
        users = replay(seen, ["user_id"]).select(columns)
        run_backup(
            spark, [Table("app", "users", users)] if mode == "full" else [], database="app",
            driver="mysql", mode=mode, at=at, destinations={"local": base}, changes=[Table("app", "users", seen)],
        )
    return restore_table(
        spark, base, "app", "app", "users", ["user_id"], driver="mysql", until="2024-02-03"
    )


@R.add(f"""
    SELECT o.*, n.n_empty, n.failed FROM ({_chain_sql(T1)}) o,
        (SELECT CAST(count(*) AS BIGINT) AS n_empty, 'public.broken' AS failed FROM region WHERE r_regionkey < 0) n
""")
def restore_around_a_failed_table(spark, sf_dir):
    """An increment in which one table fails and one has nothing new: the others are kept and restored,
    the empty one leaves no artifact, the failed one is named and holds back the state."""
    base = work_dir(spark, "skip")
    orders = load(spark, sf_dir, "orders")
    region = load(spark, sf_dir, "region").withColumn("updated_at", F.expr("TIMESTAMP_NTZ '1990-01-01'"))
    broken = region.withColumn("r_name", F.when(F.lit(True), F.raise_error(F.lit("source is gone"))).cast("string"))
    for when, mode, third in ((T0, "full", region), (T1, "incremental", broken.withColumn("updated_at", F.expr(f"TIMESTAMP_NTZ '{T1}'")))):
        manifest = run_backup(
            spark, table_set({"public.orders": _orders_at(orders, when), "public.region": region, "public.broken": third}),
            database="shop", destinations={"local": base}, mode=mode, at=when, on_error="skip",
        )
    info = parsed_meta(manifest).select(
        F.size(F.filter("info.tables", lambda t: t["table_name"] == "region")).cast("bigint").alias("n_empty"),
        F.array_join("info.failed", ",").alias("failed"),
    )
    back = restore_table(spark, base, "shop", "public", "orders", ["o_orderkey"], until=T1)
    row = info.first()
    return back.withColumns({"n_empty": F.lit(row.n_empty), "failed": F.lit(row.failed)})
