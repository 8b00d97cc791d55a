"""Retention over manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from registered.common import MANIFESTS_SQL, Registry, load, manifest_set, mode_of
from tidemark.functions.names import artifact_path, manifest_name
from tidemark.functions.stamps import stamp_column
from tidemark.operators.retention import (
    expired_artifacts as artifacts_of,
    expired_counts,
    expired_sets,
    expired_tokens,
    family_counts,
)
from tidemark.plans.backup import run_backup
from tidemark.plans.retention import all_manifests
from tidemark.sinks.formats import read_artifact
from tidemark.sinks.removal import removal_plan
from tidemark.sources.manifests import with_tokens
from tidemark.sources.tables import Table
from tidemark.workspace import work_dir

R = Registry()
AS_OF = "2024-01-31"
RANKED_SQL = f"""
    SELECT *, row_number() OVER (PARTITION BY destination, database, driver, mode
                                 ORDER BY set_ts DESC, manifest DESC) AS rn
    FROM ({MANIFESTS_SQL})
"""
COLUMNS = "destination, database, driver, mode, manifest, set_token, set_ts"


@R.add(f"SELECT {COLUMNS} FROM ({RANKED_SQL}) WHERE rn > 7")
def retention_keep(spark, sf_dir):
    """All but the newest 7 sets of every family."""
    return expired_sets(manifest_set(load(spark, sf_dir, "events")), keep=7)


@R.add(f"SELECT {COLUMNS} FROM ({MANIFESTS_SQL}) WHERE set_ts < '20240110_000000'")
def retention_days(spark, sf_dir):
    """Sets older than 21 days."""
    return expired_sets(manifest_set(load(spark, sf_dir, "events")), days=21, as_of=AS_OF)


@R.add(f"SELECT {COLUMNS} FROM ({RANKED_SQL}) WHERE rn > 400 OR set_ts < '20240110_000000'")
def retention_union(spark, sf_dir):
    """Expired by either rule."""
    return expired_sets(
        manifest_set(load(spark, sf_dir, "events")), keep=400, days=21, as_of=AS_OF
    )


@R.add("""
    SELECT destination, database, driver, mode, manifest, set_token, set_ts FROM (
        SELECT *, row_number() OVER (PARTITION BY mode ORDER BY set_ts DESC, manifest DESC) AS rn
        FROM (SELECT 's3' AS destination, 'shop' AS database, 'pgsql' AS driver,
                     CASE user_id % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'schema'
                          ELSE 'incremental' END AS mode,
                     strftime(ts, '%Y%m%d_%H%M%S') || '_' || event_id AS set_token,
                     strftime(ts, '%Y%m%d_%H%M%S') AS set_ts,
                     'shop_pg_' || CASE user_id % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'schema'
                          ELSE 'incremental' END || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '_'
                          || event_id || '.manifest.json' AS manifest
              FROM events)) WHERE rn > 1200
""")
def retention_keep_many(spark, sf_dir):
    """A keep count too large to be ranked, over three very large families."""
    events = mode_of(load(spark, sf_dir, "events"))
    named = events.select(
        F.lit("s3").alias("destination"), F.lit("shop").alias("database"),
        F.lit("pgsql").alias("driver"), "mode",
        manifest_name(
            F.lit("shop"), F.lit("pgsql"), F.col("mode"), stamp_column(F.col("ts")),
            F.col("event_id").cast("string"),
        ).alias("manifest"),
    )
    return expired_sets(with_tokens(named), keep=1200)


ARTIFACTS_SQL = """
    SELECT event_id, 's3' AS destination, event_type AS database, 'pgsql' AS driver,
           CASE user_id % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'schema' ELSE 'incremental' END AS mode,
           strftime(ts, '%Y%m%d_%H%M%S') AS set_token, user_id
    FROM events
"""


@R.add(f"""
    SELECT a.event_id, a.database || '/' || a.mode || '/public/t' || a.user_id
           || '/set=' || a.set_token AS path
    FROM ({ARTIFACTS_SQL}) a
    WHERE (a.database, a.mode, a.set_token) IN (
        SELECT (database, mode, set_token) FROM ({RANKED_SQL}) WHERE rn > 7)
""")
def expired_artifacts(spark, sf_dir):
    """Artifacts that belong to expired sets."""
    events = load(spark, sf_dir, "events")
    token = stamp_column(F.col("ts"))
    artifacts = mode_of(events).select(
        "event_id", F.lit("s3").alias("destination"), F.col("event_type").alias("database"),
        F.lit("pgsql").alias("driver"), "mode", token.alias("set_token"),
        artifact_path(
            F.col("event_type"), F.col("mode"), token, F.lit("public"),
            F.concat(F.lit("t"), F.col("user_id")),
        ).alias("path"),
    )
    expired = expired_sets(manifest_set(events), keep=7)
    return artifacts_of(expired, artifacts).select("event_id", "path")


@R.add(f"""
    SELECT destination, step, path FROM (
        SELECT destination, 0 AS step, database || '/' || mode || '/set=' || set_token AS path
        FROM ({RANKED_SQL}) WHERE rn > 7
        UNION ALL SELECT destination, 1, manifest FROM ({RANKED_SQL}) WHERE rn > 7)
""")
def removal(spark, sf_dir):
    """What a dry run lists: the files of expired manifests, then the manifests."""
    manifests = manifest_set(load(spark, sf_dir, "events")).withColumn(
        "files",
        F.array(F.concat(F.concat_ws("/", "database", "mode"), F.lit("/set="), F.col("set_token"))),
    )
    return removal_plan(expired_sets(manifests, keep=7))


@R.add(f"""
    SELECT destination, count(DISTINCT (database, driver, mode, set_token)) AS n_sets
    FROM ({RANKED_SQL}) WHERE rn > 7 GROUP BY destination
""")
def expired_per_destination(spark, sf_dir):
    return expired_counts(expired_sets(manifest_set(load(spark, sf_dir, "events")), keep=7))


@R.add(f"""
    SELECT DISTINCT destination, database, driver, mode, set_token
    FROM ({RANKED_SQL}) WHERE rn > 7
""")
def expired_set_tokens(spark, sf_dir):
    return expired_tokens(expired_sets(manifest_set(load(spark, sf_dir, "events")), keep=7))


@R.add(f"""
    SELECT destination, database, driver, mode, count(*) AS n_sets,
           greatest(0, count(*) - 7) AS excess
    FROM ({MANIFESTS_SQL}) GROUP BY destination, database, driver, mode
""")
def sets_per_family(spark, sf_dir):
    return family_counts(manifest_set(load(spark, sf_dir, "events")), 7)


@R.add("""
    SELECT destination, manifest, n_rows FROM (VALUES ('a'), ('b')) d(destination), (
        SELECT 'shop_pg_full_19990101_000000.manifest.json' AS manifest, count(*) AS n_rows
        FROM orders WHERE o_orderdate <= TIMESTAMP '1999-01-01'
        UNION ALL
        SELECT 'shop_pg_full_20010101_000000.manifest.json', count(*)
        FROM orders WHERE o_orderdate <= TIMESTAMP '2001-01-01')
""")
def retention_applied(spark, sf_dir):
    """Three full backups at two destinations, keeping two: the sets left, and the rows they hold."""
    root = work_dir(spark, "retention")
    disks = {"a": f"{root}/a", "b": f"{root}/b"}
    orders = load(spark, sf_dir, "orders")
    for at in ("1997-01-01", "1999-01-01", "2001-01-01"):
        seen = orders.filter(f"o_orderdate <= TIMESTAMP_NTZ '{at}'")
        run_backup(
            spark, [Table("main", "orders", seen)], database="shop", destinations=disks, at=at,
            retention_keep=2,
        )
    left = all_manifests(spark, disks)
    schema = T.StructType([*orders.schema.fields, T.StructField("set", T.StringType())])
    stored = reduce(DataFrame.unionByName, [
        read_artifact(spark, f"{base}/shop/full/main/orders", schema).withColumn("destination", F.lit(disk))
        for disk, base in disks.items()
    ])
    rows = stored.groupBy("destination", F.col("set").alias("set_token")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return left.join(rows, ["destination", "set_token"], "full_outer").select(
        "destination", "manifest", "n_rows"
    )
