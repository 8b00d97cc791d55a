"""Snapshots written, placed and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from registered.common import TABLES, Registry, column_sums, column_sums_sql, load
from tidemark.functions.stamps import utc_text
from tidemark.operators.selection import select_schemas
from tidemark.plans.backup import RAW_SUFFIX, run_backup
from tidemark.plans.restore import backup_chain, restore_snapshot
from tidemark.sinks.formats import CSV, read_artifact, write_artifact
from tidemark.sources.manifests import (
    MANIFEST_SCHEMA,
    manifest_artifacts,
    parsed_meta,
    read_manifests,
)
from tidemark.sources.tables import Table, parquet_tables
from tidemark.workspace import union_all, work_dir

R = Registry()
AT = "2024-02-01T00:00:00"


def _roundtrip(df: DataFrame, label: str, **options) -> DataFrame:
    path = work_dir(df.sparkSession, label)
    write_artifact(df, path, **options)
    return read_artifact(df.sparkSession, path, df.schema, fmt=options.get("fmt", "parquet"))


@R.add(column_sums_sql(TABLES))
def full_snapshot(spark, sf_dir):
    """A full backup of all tables, restored and summed up over every column of each."""
    base = work_dir(spark, "full")
    run_backup(
        spark, parquet_tables(spark, sf_dir, TABLES),
        database="shop", destinations={"local": base}, at=AT, max_parallel=8,
    )
    manifest = backup_chain(spark, base, "shop", "pgsql", AT).full
    return union_all([column_sums(name, restore_snapshot(spark, base, manifest, "main", name)) for name in TABLES])


@R.add("SELECT * FROM documents")
def full_roundtrip_documents(spark, sf_dir):
    return _roundtrip(load(spark, sf_dir, "documents"), "documents")


@R.add("SELECT * FROM lineitem")
def full_roundtrip_lineitem(spark, sf_dir):
    return _roundtrip(load(spark, sf_dir, "lineitem"), "lineitem", compression="gzip")


@R.add("SELECT * FROM documents")
def csv_roundtrip(spark, sf_dir):
    """Texts with line breaks and quotes through CSV."""
    return _roundtrip(load(spark, sf_dir, "documents"), "csv", fmt=CSV)


@R.add("SELECT * FROM pages")
def csv_roundtrip_pages(spark, sf_dir):
    return _roundtrip(load(spark, sf_dir, "pages"), "csv-pages", fmt=CSV)


@R.add("SELECT * FROM events")
def csv_gzip_roundtrip(spark, sf_dir):
    """Microseconds and JSON text through compressed CSV."""
    return _roundtrip(load(spark, sf_dir, "events"), "csv-gzip", fmt=CSV, compression="gzip")


@R.add("""
    SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS place, CAST(unnest(embedding) AS DOUBLE) AS value
    FROM embeddings
""")
def csv_nested_roundtrip(spark, sf_dir):
    """Arrays through CSV, as JSON text: every element of every vector."""
    back = _roundtrip(load(spark, sf_dir, "embeddings"), "csv-nested", fmt=CSV)
    each = back.select("vec_id", "label", F.posexplode("embedding").alias("place", "value"))
    return each.select("vec_id", "label", F.col("place").cast("bigint").alias("place"), F.col("value").cast("double").alias("value"))


@R.add("SELECT event_id, props, octet_length(encode(props)) AS n_bytes FROM events")
def csv_binary_roundtrip(spark, sf_dir):
    """Binary values through CSV, as hex."""
    events = load(spark, sf_dir, "events")
    binary = events.select("event_id", F.col("props").cast("binary").alias("body"))
    back = _roundtrip(binary, "csv-binary", fmt=CSV)
    return back.select(
        "event_id", F.decode("body", "UTF-8").alias("props"),
        F.octet_length("body").cast("bigint").alias("n_bytes"),
    )


@R.add("""
    SELECT disk, copy, e.* FROM events e, (VALUES ('a'), ('b')) d(disk), (VALUES ('gzip'), ('raw')) c(copy)
""")
def fanout_copies(spark, sf_dir):
    """Two destinations, each with a compressed and an uncompressed copy, all read back."""
    root = work_dir(spark, "fanout")
    events = load(spark, sf_dir, "events")
    disks = {"a": f"{root}/a", "b": f"{root}/b"}
    run_backup(
        spark, [Table("main", "events", events)], database="shop", destinations=disks,
        remote_map="a:arc/one,b:", at=AT, gzip=True, keep_raw=True,
    )
    copies = []
    for disk, base in (("a", f"{root}/a/arc/one"), ("b", f"{root}/b")):
        for copy, suffix in (("gzip", ""), ("raw", RAW_SUFFIX)):
            path = f"{base}/shop/full/main/events{suffix}/set=20240201_000000"
            rows = read_artifact(spark, path, events.schema)
            copies.append(rows.select(F.lit(disk).alias("disk"), F.lit(copy).alias("copy"), "*"))
    return union_all(copies)


@R.add("""
    SELECT * FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') AND c_mktsegment <> 'MACHINERY'
""")
def per_schema_snapshot(spark, sf_dir):
    """Market segments as schemas: one subtree per chosen schema, written in one pass."""
    customer = load(spark, sf_dir, "customer")
    rows = customer.withColumn("schema_name", F.col("c_mktsegment"))
    chosen = select_schemas(rows, "BUILDING,HOUSEHOLD,MACHINERY", "MACHINERY")
    path = work_dir(spark, "per-schema")
    write_artifact(chosen, path, partition_by=("schema_name",))
    return read_artifact(spark, path, chosen.schema).select(*customer.columns)


@R.add("""
    SELECT event_type AS database, event_type || '_pg_incremental_20240125_000000.manifest.json' AS manifest,
           event_type || '/incremental/public/events/set=20240125_000000' AS path,
           count(*) AS n_rows, max(ts) AS max_watermark
    FROM events WHERE ts > TIMESTAMP '2024-01-15' AND ts <= TIMESTAMP '2024-01-25'
    GROUP BY event_type
""")
def manifest_inventory(spark, sf_dir):
    """One increment per event type as a database of its own; what the listed manifests say of them."""
    base, stored = work_dir(spark, "inventory"), work_dir(spark, "by-type")
    events = load(spark, sf_dir, "events")
    write_artifact(events, stored, partition_by=("event_type",))  # each database is then one pruned read
    events = read_artifact(spark, stored, events.schema)
    for kind in [r.event_type for r in events.select("event_type").distinct().collect()]:
        run_backup(
            spark, [Table("public", "events", events.filter(F.col("event_type") == kind))],
            database=kind, destinations={"local": base}, mode="incremental", watermark_column="ts",
            since="2024-01-15", at="2024-01-25",
        )
    listed = read_manifests(spark, base)
    entries = parsed_meta(listed).select("database", "manifest", F.inline("info.tables"))
    return manifest_artifacts(listed).join(entries, ["database", "manifest", "path"]).select(
        "database", "manifest", "path", "n_rows",
        F.col("max_watermark").cast("timestamp_ntz").alias("max_watermark"),
    )


@R.add("""
    SELECT database, mode, set_token, since, len(files) AS n_files, files[1] AS first_file
    FROM (SELECT event_type AS database, CASE user_id % 2 WHEN 0 THEN 'full' ELSE 'incremental' END AS mode,
                 strftime(ts, '%Y%m%d_%H%M%S') || '_' || event_id AS set_token,
                 CASE user_id % 2 WHEN 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS since,
                 ['t/' || user_id, 't/' || event_id] AS files
          FROM events)
""")
def manifest_documents(spark, sf_dir):
    """Manifests written as JSON documents and read back; `meta` is a list for dumps, else an object."""
    full = F.col("user_id") % 2 == 0
    stamp_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    docs = load(spark, sf_dir, "events").select(
        F.concat(stamp_text, F.lit("Z")).alias("at_utc"),
        F.col("event_type").alias("database"),
        F.when(full, "full").otherwise("incremental").alias("mode"),
        F.concat_ws("_", F.date_format("ts", "yyyyMMdd_HHmmss"), "event_id").alias("note"),
        F.array(
            F.concat(F.lit("t/"), F.col("user_id")), F.concat(F.lit("t/"), F.col("event_id"))
        ).alias("files"),
        F.when(full, "[]").otherwise(
            F.to_json(
                F.struct(
                    F.lit("updated_at").alias("incremental_type"),
                    F.concat(stamp_text, F.lit("Z")).alias("since_utc"),
                )
            )
        ).alias("meta_body"),
    )
    # `meta` is nested JSON, not a quoted string: it is put in front of the other fields.
    body = F.to_json(F.struct("at_utc", "database", "mode", "note", "files"))
    line = F.concat(F.lit('{"meta":'), "meta_body", F.lit(","), F.substr(body, F.lit(2)))
    path = work_dir(spark, "manifest-documents")
    docs.select(line.alias("value")).write.text(path)
    read = parsed_meta(spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(path))
    return read.select(
        "database", "mode", F.col("note").alias("set_token"),
        F.replace(utc_text(F.col("info.since_utc"), T.TimestampType()), F.lit(" "), F.lit("T")).alias("since"),
        F.size("files").cast("bigint").alias("n_files"),
        F.element_at("files", 1).alias("first_file"),
    )
