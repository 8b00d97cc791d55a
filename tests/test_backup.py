"""Whole runs: what is written where, in which order, and what is left after a failure."""

from __future__ import annotations

import json
import os
import time
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from registered.common import TABLES
from tidemark.functions.coordinates import Coordinate
from tidemark.operators.changes import LogGapError, log_coordinates, with_seq
from tidemark.plans import backup
from tidemark.plans.backup import run_backup
from tidemark.plans.restore import (
    ChainError,
    backup_chain,
    restore_schema,
    restore_set,
    restore_snapshot,
    restore_table,
    write_restored,
)
from tidemark.plans.retention import all_manifests, apply_retention
from tidemark.sinks.formats import read_artifact
from tidemark.sinks.removal import carry_out, remove_sets
from tidemark.sources.catalog import CATALOG_SCHEMA, catalog_columns, empty_table, user_schemas
from tidemark.sources.manifests import (
    compact_manifests,
    manifest_artifacts,
    parsed_meta,
    read_manifests,
)
from tidemark.sources.state import load_coordinate, load_since
from tidemark.sources.tables import VIEW, Table, catalog_tables, parquet_tables, table_set
from tidemark.workspace import Storage, materialise, work_dir


@pytest.fixture
def base(spark):
    return work_dir(spark, "base")


def rows_at(spark, n, stamp="2024-01-01"):
    return spark.range(n).select(
        "id", F.lit("v").alias("v"), F.expr(f"TIMESTAMP_NTZ '{stamp}'").alias("updated_at")
    )


def backup_of(spark, base, at, tables, **options):
    return run_backup(
        spark, table_set(tables), database="shop", destinations={"local": base}, at=at, **options
    )


def names(manifests):
    return sorted(r.manifest for r in manifests.collect())


def broken(spark):
    return spark.range(3).select(
        "id", F.expr("TIMESTAMP_NTZ '2024-01-02'").alias("updated_at"),
        F.raise_error(F.lit("source is gone")).cast("string").alias("v"),
    )


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_full_backup_of_all_tables_restores_exactly(spark, small, base, fmt):
    tables = parquet_tables(spark, small)
    assert {t.table_name for t in tables} == set(TABLES)
    run_backup(
        spark, tables, database="shop", destinations={"local": base}, at="2024-02-01",
        fmt=fmt, gzip=True, max_parallel=8,
    )
    full = backup_chain(spark, base, "shop", "pgsql", "2024-02-01").full
    for table in tables:
        back = restore_snapshot(spark, base, full, "main", table.table_name)
        assert back.exceptAll(table.df).isEmpty() and table.df.exceptAll(back).isEmpty()


def test_manifest_document(spark, base):
    row = backup_of(
        spark, base, "2024-02-01T03:04:05+01:00", {"public.a": rows_at(spark, 3)}, note="pre x",
        connection="main-db", gzip=True,
    ).first()
    assert row.manifest == "shop_pg_full_20240201_020405_pre-x.manifest.json"
    assert row.set_token == "20240201_020405_pre-x" and row.set_ts == "20240201_020405"
    assert row.files == ["shop/full/public/a/set=20240201_020405_pre-x"]
    listed = read_manifests(spark, base, "local")
    back = listed.drop("destination").first().asDict()
    assert json.loads(back.pop("meta")) == json.loads(row.meta)
    assert back == {k: v for k, v in row.asDict().items() if k != "meta"}
    info = parsed_meta(listed).first().info
    assert [(t.table_name, t.n_rows) for t in info.tables] == [("a", 3)]
    text = spark.read.text(f"{base}/_manifests", wholetext=True).first().value
    assert list(json.loads(text))[:8] == [
        "at_utc", "connection", "driver", "database", "mode", "gzip", "note", "files"
    ]
    assert [r.path for r in manifest_artifacts(listed).collect()] == row.files


def test_foreign_manifests_are_read(spark, base):
    """Documents whose `meta` is an empty list or an object of another kind."""
    docs = {
        "a_pg_full_20240101_000000.manifest.json": [],
        "a_my_incremental_20240102_000000.manifest.json": {
            "incremental_type": "binlog", "from": {"file": "b.8", "pos": 4}, "to": {"file": "b.9", "pos": 7}
        },
        "readme.json": [],
    }
    for name, meta in docs.items():
        doc = {"at_utc": "2024-01-01T00:00:00+00:00", "driver": "pgsql", "files": ["x"], "meta": meta}
        Storage(spark).write_text(f"{base}/_manifests/{name}", json.dumps(doc))
    got = {r.manifest: r for r in parsed_meta(read_manifests(spark, base)).collect()}
    assert set(got) == set(list(docs)[:2])
    assert got["a_pg_full_20240101_000000.manifest.json"].info is None
    log = got["a_my_incremental_20240102_000000.manifest.json"].info
    assert (tuple(log["from"]), tuple(log["to"])) == (("b.8", 4), ("b.9", 7))


def test_malformed_manifest_is_an_error(spark, base):
    Storage(spark).write_text(f"{base}/_manifests/a_pg_full_20240101_000000.manifest.json", "{not json")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_manifests(spark, base).collect()


def test_schema_snapshot_and_restore(spark, small, base):
    tables = parquet_tables(spark, small, ["events", "embeddings"])
    run_backup(
        spark, tables, database="shop", destinations={"local": base}, mode="SCHEMA", at="2024-02-01"
    )
    path = f"{base}/shop/schema/catalog_columns/set=20240201_000000"
    catalog = spark.read.schema(CATALOG_SCHEMA).parquet(path)
    for table in tables:
        restored = empty_table(spark, catalog, "main", table.table_name)
        assert restored.schema == table.df.schema and restored.isEmpty()
    with pytest.raises(KeyError):
        empty_table(spark, catalog, "main", "none")


def test_per_schema(spark, base):
    tables = {f"{s}.t": rows_at(spark, 2) for s in ("a", "b", "B", "pg_catalog", "information_schema")}
    row = backup_of(
        spark, base, "2024-02-01", tables, per_schema=True, include_schemas="a,b", exclude_schemas="b"
    ).first()
    assert row.files == ["shop/full/a/t/set=20240201_000000"]
    row = backup_of(spark, base, "2024-02-02", tables, per_schema=True, mode="schema").first()
    assert row.files == [f"shop/schema/{s}/catalog_columns/set=20240202_000000" for s in "Bab"]
    with pytest.raises(ValueError, match="per_schema"):
        backup_of(spark, base, "2024-02-03", tables, include_schemas="a")
    catalog = catalog_columns(spark, table_set(tables))
    assert [r.schema_name for r in user_schemas(catalog).collect()] == ["B", "a", "b"]


def test_views_are_left_out(spark, base):
    tables = [Table("public", "t", rows_at(spark, 1)), Table("public", "v", rows_at(spark, 1), VIEW)]
    row = run_backup(spark, tables, database="shop", destinations={"local": base}, at="2024-02-01")
    assert row.first().files == ["shop/full/public/t/set=20240201_000000"]


def test_views_and_tables_of_the_session_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cat")
    spark.range(3).write.mode("overwrite").saveAsTable("cat.t")
    spark.sql("CREATE OR REPLACE VIEW cat.v AS SELECT * FROM cat.t")
    assert {(t.name, t.kind, t.df.count()) for t in catalog_tables(spark, "cat")} == {
        ("cat.t", "TABLE", 3), ("cat.v", "VIEW", 3)
    }


def test_increments_resume_and_chain(spark, base):
    """Inserts and updates over three runs; every instant can be restored."""
    def table(stamps):
        return spark.createDataFrame([(k, f"v{s}", s) for k, s in stamps.items()], "id int, v string, s string") \
            .select("id", "v", F.col("s").cast("timestamp_ntz").alias("updated_at"))
    states = {
        "2024-01-02": {1: "2024-01-01", 2: "2024-01-02"},
        "2024-01-03": {1: "2024-01-03", 2: "2024-01-02", 3: "2024-01-02T12:00:00"},
        "2024-01-04": {1: "2024-01-03", 2: "2024-01-03T00:00:01", 3: "2024-01-04", 4: "2024-01-04"},
    }
    modes = ["full", "incremental", "incremental"]
    counts = []
    for (at, stamps), mode in zip(states.items(), modes):
        since = "2024-01-02" if at == "2024-01-03" else None
        row = backup_of(spark, base, at, {"public.t": table(stamps)}, mode=mode, since=since)
        counts.append(parsed_meta(row).first().info.tables[0].n_rows)
    assert counts == [2, 2, 3]
    for at, stamps in states.items():
        got = restore_table(spark, base, "shop", "public", "t", ["id"], until=at)
        want = table(stamps)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    target = f"{base}/restored"
    write_restored(got, target)
    assert spark.read.parquet(target).count() == 4
    with pytest.raises(PySparkException):
        write_restored(got, target)
    with pytest.raises(ChainError, match="no full set"):
        restore_table(spark, base, "shop", "public", "t", ["id"], until="2024-01-01")


def test_first_increment_covers_a_day_and_lookback_reaches_back(spark, base):
    rows = rows_at(spark, 1, "2024-01-01T12:00:00").unionByName(rows_at(spark, 2, "2023-12-30"))
    tables = {"public.t": rows}
    first = parsed_meta(backup_of(spark, base, "2024-01-02", tables, mode="incremental")).first()
    assert first.info.tables[0].n_rows == 1
    second = backup_of(spark, base, "2024-01-03", tables, mode="incremental").first()
    assert second.files == []
    third = backup_of(
        spark, base, "2024-01-04", tables, mode="incremental", lookback=timedelta(days=3)
    ).first()
    assert len(third.files) == 1


def test_empty_increments_leave_nothing(spark, base):
    tables = {"public.a": rows_at(spark, 3, "2024-01-02"), "public.b": rows_at(spark, 3, "2020-01-01")}
    row = backup_of(spark, base, "2024-01-02", tables, mode="incremental", fmt="csv").first()
    assert row.files == ["shop/incremental/public/a/set=20240102_000000"]
    assert not Storage(spark).exists(f"{base}/shop/incremental/public/b/set=20240102_000000")


def test_only_tables_with_the_watermark_are_extracted(spark, base):
    tables = {
        "public.a": rows_at(spark, 1, "2024-01-02"), "public.b": spark.range(3),
        "audit.a": rows_at(spark, 1, "2024-01-02"), "public.ab": rows_at(spark, 1, "2024-01-02"),
    }
    row = backup_of(
        spark, base, "2024-01-02", tables, mode="incremental",
        include_tables="PUBLIC.*", exclude_tables="ab",
    ).first()
    assert row.files == ["shop/incremental/public/a/set=20240102_000000"]


def test_copies_at_every_destination(spark, base):
    disks = {"a": f"{base}/a", "b": f"{base}/b", "c": f"{base}/c"}
    df = rows_at(spark, 10)
    row = run_backup(
        spark, [Table("public", "t", df)], database="shop", destinations=disks, at="2024-02-01",
        gzip=True, keep_raw=True, remote_map='{"a": "arc/one/", "b": ""}', remote_path="/spare/y",
    ).first()
    assert len(row.files) == 2
    for place in ("a/arc/one", "b", "c/spare/y"):
        assert names(read_manifests(spark, f"{base}/{place}")) == [row.manifest]
        for path, mark in zip(row.files, (".gz.parquet", ".parquet")):
            copy = read_artifact(spark, f"{base}/{place}/{path}", df.schema)
            assert copy.exceptAll(df).isEmpty() and copy.count() == 10
            files = copy.inputFiles()
            assert all(f.endswith(mark) for f in files)
            assert mark == ".gz.parquet" or not any(".gz." in f for f in files)


def test_wrong_calls_fail_before_anything_is_written(spark, base):
    tables = {"public.t": rows_at(spark, 1)}
    for options in (
        {"mode": "ful"}, {"driver": "oracle"}, {"retention_keep": "seven"}, {"retention_days": -1},
        {"on_error": "ignore"}, {"driver": "mysql", "mode": "incremental"},
    ):
        with pytest.raises(ValueError):
            backup_of(spark, base, "2024-01-02", tables, **options)
    with pytest.raises(ValueError, match="same folder"):
        backup_of(spark, base, "2024-01-02", {"a b.t": rows_at(spark, 1), "a-b.t": rows_at(spark, 1)})
    assert not Storage(spark).exists(base)


def test_a_failed_run_moves_nothing(spark, base):
    good = {"public.a": rows_at(spark, 2, "2024-01-02")}
    with pytest.raises(PySparkException, match="source is gone"):
        backup_of(spark, base, "2024-01-02", good | {"public.b": broken(spark)}, mode="incremental")
    assert all_manifests(spark, {"local": base}) is None
    assert load_since(spark, f"{base}/_state", "shop", "pgsql") is None
    # The same run again, now with a sound source, takes over what was left.
    row = backup_of(spark, base, "2024-01-02", good, mode="incremental").first()
    assert len(row.files) == 1
    assert load_since(spark, f"{base}/_state", "shop", "pgsql").day == 2
    with pytest.raises(FileExistsError):
        backup_of(spark, base, "2024-01-02", good, mode="incremental")


def test_skipped_tables_hold_back_state(spark, base):
    full = {"public.a": rows_at(spark, 2), "public.b": rows_at(spark, 2)}
    backup_of(spark, base, "2024-01-01", full)
    changed = {"public.a": rows_at(spark, 3, "2024-01-02"), "public.b": broken(spark)}
    row = backup_of(spark, base, "2024-01-02", changed, mode="incremental", since="2024-01-01", on_error="skip")
    assert list(parsed_meta(row).first().info.failed) == ["public.b"]
    assert load_since(spark, f"{base}/_state", "shop", "pgsql") is None
    args = (spark, base, "shop", "public")
    assert restore_table(*args, "a", ["id"], until="2024-01-02").count() == 3
    with pytest.raises(ChainError, match="failed for public.b"):
        restore_table(*args, "b", ["id"], until="2024-01-02")
    changed["public.b"] = rows_at(spark, 4, "2024-01-02")
    backup_of(spark, base, "2024-01-03", changed, mode="incremental", since="2024-01-01")
    assert restore_table(*args, "b", ["id"], until="2024-01-03").count() == 4


def test_chain_with_a_hole_is_refused(spark, base):
    tables = {"public.t": rows_at(spark, 2, "2024-01-05")}
    backup_of(spark, base, "2024-01-01", tables)
    backup_of(spark, base, "2024-01-05", tables, mode="incremental", since="2024-01-02")
    with pytest.raises(ChainError, match="does not join"):
        restore_table(spark, base, "shop", "public", "t", ["id"], until="2024-01-05")


def test_columns_that_vanish_or_change_are_refused(spark, base):
    backup_of(spark, base, "2024-01-01", {"public.t": rows_at(spark, 2)})
    for at, df in (
        ("2024-01-02", rows_at(spark, 2, "2024-01-02")),
        ("2024-01-03", rows_at(spark, 2, "2024-01-03").withColumn("w", F.lit(1))),
        ("2024-01-04", rows_at(spark, 2, "2024-01-04").withColumn("w", F.lit("1"))),
    ):
        backup_of(spark, base, at, {"public.t": df}, mode="incremental")
    for day in (2, 3):
        assert restore_table(spark, base, "shop", "public", "t", ["id"], until=f"2024-01-0{day}").count() == 2
    with pytest.raises(ChainError, match="columns"):
        restore_table(spark, base, "shop", "public", "t", ["id"], until="2024-01-04")


def change_table(spark, upto):
    rows = [
        ("bin.9", 4, "write", 1, "a"), ("bin.9", 90, "write", 2, "b"), ("bin.10", 4, "write", 1, "c"),
        ("bin.10", 70, "delete", 2, None), ("bin.11", 4, "write", 3, "d"), ("bin.11", 8, "write", 4, "e"),
    ]
    df = spark.createDataFrame(rows[:upto], "file string, pos long, op string, k int, v string")
    return [Table("public", "t", with_seq(df))]


def log_backup(spark, base, at, changes, **options):
    options.setdefault("mode", "incremental")
    return run_backup(
        spark, options.pop("tables", []), database="shop", destinations={"local": base}, at=at,
        driver="MariaDB", changes=changes, **options,
    )


def test_log_increments(spark, base):
    snapshot = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    full = log_backup(
        spark, base, "2024-01-01", change_table(spark, 2), mode="full",
        tables=[Table("public", "t", snapshot)],
    )
    assert tuple(parsed_meta(full).first().info["to"]) == ("bin.9", 91)
    first = log_backup(
        spark, base, "2024-01-02", change_table(spark, 3), log_start=Coordinate("bin.9", 91)
    )
    info = parsed_meta(first).first().info
    assert (tuple(info["from"]), tuple(info["to"])) == (("bin.9", 91), ("bin.10", 5))
    assert load_coordinate(spark, f"{base}/_state", "shop", "mysql") == ("bin.10", 5)
    log_backup(spark, base, "2024-01-03", change_table(spark, 6))
    nothing = log_backup(spark, base, "2024-01-04", change_table(spark, 6)).first()
    assert nothing.files == []
    def at(day):
        got = restore_table(
            spark, base, "shop", "public", "t", ["k"], driver="mysql", until=f"2024-01-0{day}"
        )
        return {r.k: r.v for r in got.collect()}
    assert at(1) == {1: "a", 2: "b"}
    assert at(2) == {1: "c", 2: "b"}
    assert at(3) == at(4) == {1: "c", 3: "d", 4: "e"}


def test_first_log_increment_starts_at_the_current_file(spark, base):
    info = parsed_meta(log_backup(spark, base, "2024-01-02", change_table(spark, 6))).first().info
    assert tuple(info["from"]) == ("bin.11", 4) and info.tables[0].n_rows == 2


def test_a_log_gap_moves_nothing(spark, base):
    log_backup(spark, base, "2024-01-02", change_table(spark, 2))
    table = change_table(spark, 6)[0]
    purged = [Table("public", "t", table.df.filter("seq <> 10"))]
    before = load_coordinate(spark, f"{base}/_state", "shop", "mysql")
    with pytest.raises(LogGapError, match="missing"):
        log_backup(spark, base, "2024-01-03", purged)
    with pytest.raises(LogGapError, match="reset"):
        log_backup(spark, base, "2024-01-03", [Table("public", "t", table.df.filter("seq < 9"))])
    assert load_coordinate(spark, f"{base}/_state", "shop", "mysql") == before
    assert len(names(read_manifests(spark, base))) == 1
    files = spark.createDataFrame([("bin.9",), ("bin.10",), ("bin.11",)], "file string")
    log_backup(spark, base, "2024-01-03", purged, log_files=files)


def test_order_of_commitment(spark, base, monkeypatch):
    done = []
    def log(name):
        real = getattr(backup, name)
        def wrapped(*args, **kwargs):
            done.append(name)
            return real(*args, **kwargs)
        monkeypatch.setattr(backup, name, wrapped)
    for name in ("write_artifact", "copy_artifact", "write_manifest", "save_state", "apply_retention"):
        log(name)
    run_backup(
        spark, [Table("public", "t", rows_at(spark, 1, "2024-01-02"))], database="shop", at="2024-01-02",
        destinations={"a": f"{base}/a", "b": f"{base}/b"}, mode="incremental", retention_keep=1,
    )
    assert done == ["write_artifact", "copy_artifact", "write_manifest", "write_manifest",
                    "save_state", "apply_retention"]


def test_state_keeps_microseconds_and_history(spark, base):
    tables = {"public.t": rows_at(spark, 1)}
    for at in ("2024-01-02T03:04:05.123456+01:00", "2024-01-02T04:00:00.000001Z"):
        row = backup_of(spark, base, at, tables, mode="incremental", connection="a/b")
    state = f"{base}/_state"
    assert load_since(spark, state, "a/b", "pgsql").isoformat() == "2024-01-02T04:00:00.000001+00:00"
    assert load_since(spark, state, "a-b", "pgsql") is None
    assert len(Storage(spark).child_names(f"{state}/a-b_pgsql_state")) == 2
    info = parsed_meta(row).select(F.unix_micros("info.since_utc").alias("s")).first()
    assert info.s % 1_000_000 == 123456


def test_malformed_state_is_an_error(spark, base):
    Storage(spark).write_text(f"{base}/_state/shop_pgsql_state/x.json", "{broken")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        load_since(spark, f"{base}/_state", "shop", "pgsql")


def test_retention_removes_exactly_the_expired_sets(spark, base):
    disks = {"a": f"{base}/a", "b": f"{base}/b"}
    def run(database, at, **options):
        return run_backup(
            spark, [Table("public", "t", rows_at(spark, 1))], database=database, destinations=disks,
            at=at, **options,
        )
    for day in (1, 2, 3):
        run("app", f"2024-01-0{day}")
        run("myapp", f"2024-01-0{day}")
        run("app", f"2024-01-0{day}", mode="schema")
    plan = apply_retention(spark, disks, keep=1, database="app", mode="full")
    assert plan.count() == 8 and all_manifests(spark, disks).count() == 18
    run("app", "2024-01-04", retention_keep=2)
    left = names(read_manifests(spark, disks["a"]))
    assert left == names(read_manifests(spark, disks["b"]))
    assert [n for n in left if n.startswith("app_pg_full")] == [
        f"app_pg_full_2024010{d}_000000.manifest.json" for d in (3, 4)
    ]
    assert len([n for n in left if n.startswith(("myapp", "app_pg_schema"))]) == 6
    storage = Storage(spark)
    for day, there in ((1, False), (2, False), (3, True), (4, True)):
        assert storage.exists(f"{base}/b/app/full/public/t/set=2024010{day}_000000") == there
        assert storage.exists(f"{base}/b/myapp/full/public/t/set=2024010{day}_000000") == (day < 4)
    apply_retention(spark, disks, days=3, as_of="2024-01-06", dry_run=False)
    assert {n.split("_")[-2] for n in names(all_manifests(spark, disks))} == {"20240103", "20240104"}


def test_removal_stays_below_the_base(spark, base):
    for path in ("../other", "/", "a/../../b", ""):
        expired = spark.createDataFrame(
            [("local", "x_pg_full_20240101_000000.manifest.json", [path])],
            "destination string, manifest string, files array<string>",
        )
        with pytest.raises(ValueError, match="refusing"):
            remove_sets(spark, expired, {"local": base}, dry_run=False)


def test_a_full_set_and_increments_with_nothing_but_defaults_are_a_chain(spark, base):
    tables = {"public.t": rows_at(spark, 2, "2024-01-01")}
    backup_of(spark, base, "2024-01-02", tables)
    changed = {"public.t": rows_at(spark, 3, "2024-01-03")}
    first = parsed_meta(backup_of(spark, base, "2024-01-05", changed, mode="incremental")).first().info
    assert first.since_utc.isoformat().startswith("2024-01-02")
    backup_of(spark, base, "2024-01-09", {"public.t": rows_at(spark, 4, "2024-01-08")}, mode="incremental")
    back = restore_table(spark, base, "shop", "public", "t", ["id"], until="2024-01-09")
    assert {(r.id, r.updated_at.day) for r in back.collect()} == {(k, 8) for k in range(4)}
    # A later full set takes nothing back: the next increment goes on from saved state, and joins it too.
    backup_of(spark, base, "2024-01-10", changed)
    last = parsed_meta(backup_of(spark, base, "2024-01-11", changed, mode="incremental")).first().info
    assert last.since_utc.isoformat().startswith("2024-01-09")
    assert restore_table(spark, base, "shop", "public", "t", ["id"], until="2024-01-11").count() == 3


def test_the_full_set_of_another_connection_is_no_start(spark, base):
    tables = {"public.t": rows_at(spark, 2, "2024-01-01")}
    backup_of(spark, base, "2024-01-02", tables, connection="one")
    info = parsed_meta(backup_of(spark, base, "2024-01-05", tables, mode="incremental", connection="two")).first().info
    assert info.since_utc.isoformat().startswith("2024-01-04")


def test_log_chain_with_defaults(spark, base):
    log = with_seq(spark.createDataFrame(
        [(f"bin.{8 + k // 10}", 4 + k % 10, "write", k % 7, k) for k in range(50)], "file string, pos bigint, op string, id int, v int"
    ))
    def at(n):
        return log.filter(F.col("v") < n)
    def rows(n):
        return spark.createDataFrame([(k, max(v for v in range(n) if v % 7 == k)) for k in range(7)], "id int, v int")
    for day, mode, n in ((1, "full", 15), (2, "incremental", 30), (3, "incremental", 50)):
        run_backup(
            spark, [Table("a", "t", rows(n))] if mode == "full" else [], database="shop", driver="mariadb", mode=mode,
            destinations={"local": base}, at=f"2024-01-0{day}", changes=[Table("a", "t", at(n))],
        )
    back = restore_table(spark, base, "shop", "a", "t", ["id"], driver="mysql", until="2024-01-03")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in rows(50).collect()}


def test_a_run_opens_only_its_familys_documents(spark, base):
    """100,000 foreign manifests and as many old states, of which any would fail to be read."""
    tables = {"public.t": rows_at(spark, 2, "2024-01-01")}
    backup_of(spark, base, "2024-01-02", tables)
    bad = Path(base.removeprefix("file:")) / "bad.json"
    bad.write_text("{not json")
    where = bad.parent / "_manifests"
    for k in range(100_000):
        os.link(bad, where / f"other{k % 97}_pg_full_{20000101 + k % 28}_{k:06d}.manifest.json") if k % 30_000 else None
        if k and not k % 20_000:  # a file holds only so many names
            bad = bad.with_name(f"bad{k}.json")
            bad.write_text("{not json")
    states = bad.parent / "_state/shop_pgsql_state"
    states.mkdir(parents=True)
    for k in range(1000):
        os.link(bad, states / f"shop_pg_incremental_20200101_{k:06d}.json")
    (states / "shop_pg_incremental_20240102_120000.json").write_text(
        '{"connection": "shop", "driver": "pgsql", "set_id": "x", "saved_utc": "2024-01-02T12:00:00+00:00", "since_utc": "2024-01-02T00:00:00+00:00"}'
    )
    info = parsed_meta(backup_of(spark, base, "2024-01-04", {"public.t": rows_at(spark, 3, "2024-01-03")}, mode="incremental", retention_keep=5)).first().info
    assert info.since_utc.isoformat().startswith("2024-01-02T00:00")
    assert restore_table(spark, base, "shop", "public", "t", ["id"], until="2024-01-04").count() == 3


def test_manifests_of_a_family_are_indexed(spark, base, monkeypatch):
    def document(day, database="shop", at=None):
        name = f"{database.replace('/', '-')}_pg_full_202401{day:02d}_000000.manifest.json"
        meta = {"upper_utc": f"2024-01-{day:02d}T00:00:00Z", "tables": []}
        doc = {"at_utc": f"2024-01-{day:02d}T00:00:00Z", "driver": "pgsql", "database": database, "mode": "full", "files": [f"f{day}"], "meta": meta}
        Storage(spark).write_text(f"{base}/_manifests/{name}", json.dumps(doc))
        return name

    def own(**family):
        return names(read_manifests(spark, base, database="shop", **family))

    first = [document(d) for d in range(1, 7)]
    document(1, "shop_pg_full")  # its name starts alike
    assert own() == own(driver="pgsql", mode="full") == first
    assert not compact_manifests(spark, base, "shop", "pgsql", "full", least=7)
    assert compact_manifests(spark, base, "shop", "pgsql", "full", least=3)
    want = read_manifests(spark, base).filter("database = 'shop'").orderBy("manifest").collect()
    assert read_manifests(spark, base, database="shop").orderBy("manifest").collect() == want
    # Indexed documents are not opened again; those that came since are; those removed are gone.
    for name in first[1:]:
        file = Path(base.removeprefix("file:")) / "_manifests" / name
        file.write_text("{not json")
        file.with_name(f".{name}.crc").unlink(missing_ok=True)
    Storage(spark).delete(f"{base}/_manifests/{first[0]}")
    late = [document(d) for d in range(10, 14)]
    assert own() == own(driver="pgsql", mode="full") == first[1:] + late
    assert compact_manifests(spark, base, "shop", "pgsql", "full", least=3)
    assert own() == first[1:] + late
    late += [document(d) for d in range(20, 24)]
    assert compact_manifests(spark, base, "shop", "pgsql", "full", least=3) and own() == first[1:] + late
    versions = Storage(spark).child_names(f"{base}/_manifests/_index/shop_pg_full_")
    assert versions == ["v=000000001", "v=000000002"]
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_manifests(spark, base).collect()  # all documents


def test_a_set_of_tables_is_restored_with_added_columns(spark, base):
    def tables(day, wide):
        t = rows_at(spark, 2 + day, f"2024-01-0{day}")
        t = t.withColumn("w", F.lit(day)) if wide else t
        return {"public.t": t, "public.u": rows_at(spark, 3, "2024-01-01"), "audit.t": rows_at(spark, day, f"2024-01-0{day}")}
    for day, mode, fmt in ((1, "full", "parquet"), (2, "incremental", "csv"), (3, "incremental", "parquet"), (4, "incremental", "csv")):
        backup_of(spark, base, f"2024-01-0{day}T12:00:00", tables(day, day >= 3), mode=mode, fmt=fmt)
    keys = {"public.t": ["id"], "audit.t": ["id"]}
    back = restore_set(spark, base, "shop", keys, until="2024-01-05")
    assert set(back) == {"public.t", "public.u", "audit.t"}
    assert {(r.id, r.updated_at.day, r.w) for r in back["public.t"].collect()} == {(k, 4, 4) for k in range(6)}
    assert back["audit.t"].count() == 4 and back["public.u"].count() == 3
    mid = restore_set(spark, base, "shop", keys, until="2024-01-03T12:00:00")["public.t"]
    assert {(r.id, r.w) for r in mid.collect()} == {(k, 3) for k in range(5)}
    with pytest.raises(KeyError, match="audit.t"):
        restore_set(spark, base, "shop", {"public.t": ["id"]}, until="2024-01-05")
    with pytest.raises(KeyError, match="public.x"):
        restore_set(spark, base, "shop", keys | {"public.x": ["id"]}, until="2024-01-05")
    backup_of(spark, base, "2024-01-06", {"public.t": rows_at(spark, 9, "2024-01-05")}, mode="incremental")
    with pytest.raises(ChainError, match="'w'"):  # a column is gone
        restore_set(spark, base, "shop", keys, until="2024-01-06")


def test_each_increment_is_read_once(spark, base):
    backup_of(spark, base, "2024-01-01", {"public.t": rows_at(spark, 50)})
    backup_of(spark, base, "2024-01-02", {"public.t": rows_at(spark, 5, "2024-01-02")}, mode="incremental")
    back = restore_table(spark, base, "shop", "public", "t", ["id"], until="2024-01-02")
    folders = {f.rpartition("/tidemark/")[2].split("/")[1].split("-")[0] for f in back.inputFiles()}
    assert folders == {"base", "latest"} and not any("/incremental/" in f for f in back.inputFiles())
    assert "HashAggregate" not in back._jdf.queryExecution().executedPlan().toString()


def test_schema_sets_are_restored_by_their_manifest(spark, small, base):
    tables = [Table("a", t.table_name, t.df) if t.table_name < "n" else t for t in parquet_tables(spark, small)]
    with pytest.raises(ChainError, match="no schema set"):
        restore_schema(spark, base, "shop", until="2024-01-05")
    for day, options in ((1, {"per_schema": True, "include_schemas": "a"}), (2, {"fmt": "csv"}), (3, {"per_schema": True})):
        run_backup(spark, tables, database="shop", destinations={"local": base}, mode="schema", at=f"2024-01-0{day}", **options)
    want = {t.name: t.df.schema for t in tables}
    assert set(restore_schema(spark, base, "shop", until="2024-01-01")) == {n for n in want if n.startswith("a.")}
    for day in (2, 3):
        back = restore_schema(spark, base, "shop", until=f"2024-01-0{day}")
        assert {n: df.schema for n, df in back.items()} == want and all(df.isEmpty() for df in back.values())


def test_a_thousand_change_tables_are_one_inventory(spark):
    one = with_seq(spark.createDataFrame([("bin.9", 4, 1), ("bin.10", 8, 2)], "file string, pos bigint, v int"))
    began = time.perf_counter()
    log = log_coordinates([Table("a", f"t{k}", one.withColumn("v", F.lit(k))) for k in range(1000)])
    assert log.columns == ["file", "seq", "pos"] and time.perf_counter() - began < 30


def test_removal_goes_on_where_it_stopped(spark, base):
    storage = Storage(spark)
    rows = [("a", 0, f"shop/full/t/set={k}") for k in range(300)] + [("a", 1, f"m{k}.manifest.json") for k in range(20)]
    for _, step, path in rows:
        storage.write_text(f"{base}/_manifests/{path}" if step else f"{base}/{path}/part", "x")
    plan = materialise(spark.createDataFrame([*rows, ("b", 0, "x")], "destination string, step int, path string"), "plan")
    with pytest.raises(KeyError):  # a destination that is not known: no manifest is touched
        carry_out(spark, plan, {"a": base}, max_parallel=3)
    assert len(storage.child_names(f"{base}/_manifests")) >= 20
    done = carry_out(spark, plan.filter("destination = 'a'"), {"a": base}, max_parallel=3)
    assert done == 320 and storage.child_names(f"{base}/_manifests") == [] and storage.child_names(f"{base}/shop/full/t") == []
