"""Change logs, upserts and extracts on small fixtures, against plain models."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.functions.coordinates import Coordinate
from tidemark.operators import changes as ch
from tidemark.operators import restore
from tidemark.operators.incremental import highest_watermark, incremental_extract, resume_window
from tidemark.operators.restore import InvalidKeyError, apply_changes, upsert, upsert_partitions
from tidemark.plans.restore import upsert_in_place
from tidemark.sinks.formats import read_artifact, write_artifact
from tidemark.workspace import work_dir

LOG = "file string, pos long, op string, k long, v string"


def random_log(seed, n=400, keys=12):
    """Positions grow inside each file; one key gets a third of all changes."""
    rng = random.Random(seed)
    rows, number, pos = [], 8, 4
    for i in range(n):
        if rng.random() < 0.05:
            number, pos = number + 1, 4
        key = 0 if rng.random() < 1 / 3 else rng.randrange(keys)
        op = "delete" if rng.random() < 0.2 else "write"
        rows.append((f"bin.{number}", pos, op, key, f"v{i}"))
        pos += rng.randint(1, 100)
    return rows


def frame(spark, rows):
    return ch.with_seq(spark.createDataFrame(random.Random(1).sample(rows, len(rows)), LOG))


def model(base, rows):
    state = dict(base)
    for _, _, op, key, value in rows:
        state.pop(key, None)
        if op == "write":
            state[key] = value
    return state


@pytest.mark.parametrize("seed", range(3))
def test_replay_and_apply(spark, seed):
    rows = random_log(seed)
    cut = len(rows) // 2
    half = model({}, rows[:cut])
    log = frame(spark, rows)
    assert {r.k: r.v for r in ch.replay(log, ["k"]).collect()} == model({}, rows)
    base = spark.createDataFrame(list(half.items()), "k long, v string")
    rest = ch.log_slice(log, Coordinate(*rows[cut][:2]), ch.log_end(log))
    applied = apply_changes(base, rest, ["k"])
    assert {r.k: r.v for r in applied.collect()} == model({}, rows)
    again = apply_changes(applied, rest, ["k"])
    assert {r.k: r.v for r in again.collect()} == model({}, rows)


def test_slices_are_half_open_and_join_up(spark):
    rows = random_log(7)
    log = frame(spark, rows)
    marks = [Coordinate(*rows[i][:2]) for i in (10, 11, 150, 300)]
    values = [r[4] for r in rows]
    taken = []
    for start, end in zip(marks, marks[1:]):
        taken += [r.v for r in ch.log_slice(log, start, end).collect()]
    assert sorted(taken) == sorted(values[10:300])
    assert ch.log_slice(log, marks[0], marks[0]).isEmpty()
    end = ch.log_end(log)
    assert end == ch.log_end(log, from_seq=end.seq) == (rows[-1][0], rows[-1][1] + 1)
    assert ch.log_slice(log, Coordinate("bin.8", 4), end).count() == len(rows)
    assert ch.start_of_current(end) == (end.file, 4)


def test_natural_order_of_files(spark):
    rows = [("bin.10", 4, "write", 1, "new"), ("bin.9", 900, "write", 1, "old")]
    log = frame(spark, rows)
    assert ch.log_end(log).file == "bin.10"
    assert ch.replay(log, ["k"]).first().v == "new"
    assert [r.file for r in ch.log_inventory(log).collect()] == ["bin.9", "bin.10"]


def test_gaps(spark):
    rows = [(f"bin.{n}", 4, "write", 1, "v") for n in (8, 9, 12, 13)]
    log = frame(spark, rows)
    at = lambda n, pos=4: Coordinate(f"bin.{n}", pos)
    assert [r.seq for r in ch.log_gaps(log, 7, 13).orderBy("seq").collect()] == [7, 10, 11]
    ch.require_complete(log, at(8), at(9))
    ch.require_complete(log, at(13), at(13))
    for start, end in ((at(9), at(12)), (at(7), at(8)), (at(13, 9), at(13, 8)), (at(13), at(8))):
        with pytest.raises(ch.LogGapError):
            ch.require_complete(log, start, end)
    files = spark.createDataFrame([(f"bin.{n}",) for n in range(8, 14)], "file string")
    ch.require_complete(log, at(9), at(12), files)
    with pytest.raises(ch.LogGapError, match="reset"):
        ch.log_end(log, from_seq=14)
    with pytest.raises(ch.LogGapError, match="empty"):
        ch.log_end(log.limit(0))


def test_stored_log_is_pruned_by_file(spark):
    rows = random_log(3)
    path = work_dir(spark, "t")
    log = frame(spark, rows)
    write_artifact(ch.ordered_slice(log, cluster=True), path, partition_by=("seq",))
    stored = read_artifact(spark, path, log.schema)
    sliced = ch.log_slice(stored, Coordinate("bin.10", 4), Coordinate("bin.12", 50))
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(seq" in plan and ">= 10)" in plan and "<= 12)" in plan
    want = sorted(r[4] for r in rows if (10, 4) <= (int(r[0][4:]), r[1]) < (12, 50))
    assert sorted(r.v for r in sliced.collect()) == want


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "y")], "k int, v string, p string")
    inc = spark.createDataFrame([("y", "C", 3), ("z", None, 4)], "p string, v string, k int")
    want = {(1, "a", "x"), (2, "b", "x"), (3, "C", "y"), (4, None, "z")}
    done = upsert(base, inc, ["k"])
    assert {tuple(r) for r in done.collect()} == want
    assert {tuple(r) for r in upsert(done, inc, ["k"]).collect()} == want
    touched = upsert_partitions(base, inc, ["p", "k"], ["p"])
    assert {tuple(r) for r in touched.collect()} == {(3, "C", "y"), (4, None, "z")}
    with pytest.raises(ValueError, match="part of the key"):
        upsert_partitions(base, inc, ["k"], ["p"])


@pytest.mark.parametrize("others", [10, 501])
def test_any_number_of_partitions_with_null(spark, others):
    path = work_dir(spark, "many")
    base = spark.range(others + 5).select(
        "id", F.lit("old").alias("v"), F.when(F.col("id") >= 5, F.col("id").cast("int")).alias("p")
    )
    write_artifact(base.coalesce(1), path, partition_by=("p",))
    increment = base.filter("id >= 4").withColumn("v", F.lit("new"))
    upsert_in_place(path, base.schema, increment, ["p", "id"], ["p"], check_keys=False)
    rows = {tuple(r) for r in read_artifact(spark, path, base.schema).select("id", "v").collect()}
    assert rows == {(k, "old" if k < 4 else "new") for k in range(others + 5)}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_scattered_partitions_are_all_that_is_read(spark, adaptive):
    """Of 600 partitions every file that need not be read is ruined: reading one would fail."""
    path = work_dir(spark, "scattered")
    touched = {0, 3, 299, 599}
    base = spark.range(601).select(
        "id", F.lit("old").alias("v"), F.when(F.col("id") < 600, F.col("id").cast("int")).alias("p"), (F.col("id") % 2).alias("q")
    )
    write_artifact(base.coalesce(1), path, partition_by=("p", "q"))
    for file in Path(path.removeprefix("file:")).rglob("*.parquet"):
        part = file.parent.parent.name.removeprefix("p=")
        if part != "__HIVE_DEFAULT_PARTITION__" and int(part) not in touched:
            file.write_bytes(b"ruined")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    increment = base.filter(F.col("p").isin(sorted(touched)) | F.col("p").isNull()).withColumn("v", F.lit("new"))
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        upsert_in_place(path, base.schema, increment, ["p", "q", "id"], ["p", "q"], check_keys=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    kept = F.col("p").isin(sorted(touched)) | F.col("p").isNull()
    rows = {tuple(r) for r in read_artifact(spark, path, base.schema).filter(kept).select("id", "v").collect()}
    assert rows == {(k, "new") for k in (*touched, 600)}


def test_touched_partitions_are_all_that_is_replaced(spark):
    path = work_dir(spark, "t")
    target = spark.range(40).select("id", F.lit("old").alias("v"), (F.col("id") % 4).alias("p"))
    target = target.withColumn("p", F.when(F.col("p") != 3, F.col("p")))
    write_artifact(target, path, partition_by=("p",))
    before = set(spark.read.parquet(path).inputFiles())
    increment = target.filter("id < 8 and p = 1").withColumn("v", F.lit("new"))
    stored = read_artifact(spark, path, target.schema)
    plan = upsert_partitions(stored, increment, ["p", "id"], ["p"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan) and "isnull(p" in plan
    upsert_in_place(path, target.schema, increment, ["p", "id"], ["p"])
    after = spark.read.schema(target.schema).parquet(path)
    assert {r.id: r.v for r in after.collect()} == {
        i: "new" if i in (1, 5) else "old" for i in range(40)
    }
    kept = {f for f in before if "/p=1/" not in f}
    assert kept < set(after.inputFiles()) and not (before - kept) & set(after.inputFiles())


def test_upsert_refuses_bad_input(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    null = spark.createDataFrame([(None, "a")], "k int, v string")
    for left, right in ((base, twice), (base, null), (twice, base), (null, base)):
        with pytest.raises(InvalidKeyError):
            upsert(left, right, ["k"], check_base=True)
    assert upsert(twice, base.filter("k = 2"), ["k"]).count() == 3  # the base is taken as it is
    wider = base.withColumn("w", F.lit(1))
    with pytest.raises(ValueError, match="columns differ"):
        upsert(base, wider, ["k"])
    merged = upsert(base, wider.filter("k = 1"), ["k"], allow_missing_columns=True)
    assert {tuple(r) for r in merged.collect()} == {(1, "a", 1), (2, "b", None)}
    with pytest.raises(ValueError, match="lack columns"):
        apply_changes(wider, base.withColumns({"op": F.lit("write"), "seq": F.lit(1), "pos": F.lit(1)}), ["k"])


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_extract_bounds(spark, kind):
    moments = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", None]
    df = spark.createDataFrame([(m,) for m in moments], "m string").select(F.col("m").cast(kind).alias("c"))
    def days(*bounds):
        return sorted(r.c.day for r in incremental_extract(df, "c", *bounds).collect())
    assert days("2024-01-01", "2024-01-03") == [2, 3]
    assert days("2024-01-01") == [2, 3]
    assert days("2023-12-31T23:59:59", "2024-01-02T23:00:00") == [1, 2]
    assert days("2024-01-02T01:00:00+02:00", "2024-01-02") == [2]
    assert days("2024-01-03", "2024-01-03") == []


def test_highest_watermark_is_utc_in_any_session(spark):
    micros = 1_759_226_400_123_456
    ltz = spark.range(1).select(F.timestamp_micros(F.lit(micros)).alias("c"))
    ntz = spark.range(1).select(F.expr("TIMESTAMP_NTZ '2025-09-30 10:00:00.123456'").alias("c"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        tops = [highest_watermark(df, "c") for df in (ltz, ntz)]
        written = write_artifact(ltz, work_dir(spark, "t"), watermark="c")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [t.isoformat() for t in tops] == ["2025-09-30T10:00:00.123456+00:00"] * 2
    assert written.max_watermark == "2025-09-30 10:00:00.123456"
    assert highest_watermark(ltz.limit(0), "c") is None


def test_extract_needs_a_time_column(spark):
    with pytest.raises(TypeError):
        incremental_extract(spark.range(1), "id", "2024-01-01")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_extract_is_pushed_into_the_scan(spark, kind):
    path = work_dir(spark, "t")
    spark.range(10).select(F.expr(f"cast('2024-01-01' as {kind})").alias("c"), "id").write.parquet(path)
    rows = incremental_extract(spark.read.parquet(path), "c", "2023-01-01", "2025-01-01").select("id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThan(c," in pushed and "LessThanOrEqual(c," in pushed


def test_window_precedence():
    day = resume_window("2024-01-10", since="2024-01-05", saved="2024-01-07")
    assert day.since.day == 5 and day.upper.day == 10
    assert resume_window("2024-01-10", saved="2024-01-07").since.day == 7
    assert resume_window("2024-01-10").since.day == 9


def test_ranges_join_up(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    a, b, c = "2024-01-03", "2024-01-11T13:00:00", "2024-01-20"
    parts = incremental_extract(events, "ts", a, b).unionByName(incremental_extract(events, "ts", b, c))
    whole = incremental_extract(events, "ts", a, c)
    assert parts.exceptAll(whole).isEmpty() and whole.exceptAll(parts).isEmpty()


@pytest.mark.parametrize("cluster", [True, False])
def test_slices_are_stored_in_log_order(spark, cluster):
    """Every file of a stored slice is sorted by position, one log file per folder."""
    log = spark.range(20_000, numPartitions=5).select(
        F.concat(F.lit("bin."), F.pmod(F.hash("id"), F.lit(4))).alias("file"),
        F.xxhash64("id").alias("pos"), F.lit("write").alias("op"), F.col("id").alias("k"),
    )
    path = work_dir(spark, "t")
    write_artifact(ch.ordered_slice(ch.with_seq(log), cluster), path, partition_by=("seq",))
    files = [f.removeprefix("file://") for f in spark.read.parquet(path).inputFiles()]
    assert len(files) >= 4
    for file in files:
        positions = pq.ParquetFile(file).read(["pos"])["pos"].to_pylist()
        assert positions == sorted(positions)


def test_user_columns_may_have_our_old_names(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (2, 6, "b")], "n int, last int, batch string")
    done = upsert(rows, rows.withColumn("batch", F.lit("c")), ["n", "last"])
    assert {tuple(r) for r in done.collect()} == {(1, 5, "c"), (2, 6, "c")}
    log = spark.createDataFrame([("bin.8", 4, "write", 1, "x"), ("bin.8", 9, "write", 1, "y")], "file string, pos bigint, op string, last int, n string")
    assert [tuple(r) for r in ch.replay(ch.with_seq(log), ["last"]).select("last", "n").collect()] == [(1, "y")]
    with pytest.raises(ValueError, match="reserved"):
        ch.with_seq(log.withColumn("seq", F.lit(77)))
    assert ch.with_seq(ch.declare_seq(log.withColumn("seq", F.lit(8)))).columns[-1] == "seq"
