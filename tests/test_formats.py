"""Artifacts written and read back."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from registered.common import TABLES, load
from tidemark.sinks.formats import CSV, PARQUET, read_artifact, write_artifact
from tidemark.workspace import work_dir


def roundtrip(df, **options):
    path = work_dir(df.sparkSession, "t")
    write_artifact(df, path, **options)
    return read_artifact(df.sparkSession, path, df.schema, fmt=options.get("fmt", PARQUET))


def same(a, b):
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("fmt", [PARQUET, CSV])
@pytest.mark.parametrize("table", TABLES)
def test_every_table(spark, small, table, fmt):
    df = load(spark, small, table)
    same(roundtrip(df, fmt=fmt, compression="gzip"), df)


def test_awkward_text(spark):
    values = [
        "", None, " ", " lead", "trail ", '"', '""', '"quoted"', "a,b", "a\nb", "a\r\nb", "a\rb", "\n",
        "\\", "\\n", "\\\\N", "N", "null", "NULL", "#comment", "é漢字😀", "\t", "'", 'x"y,z\n"', "\\\"",
    ]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, a string, b string")
    got = {r.i: (r.a, r.b) for r in roundtrip(df, fmt=CSV).collect()}
    assert got == {i: (v, v) for i, v in enumerate(values)}


def test_single_empty_column(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "a string")
    assert sorted(map(repr, (r.a for r in roundtrip(df, fmt=CSV).collect()))) == ["''", "'x'", "None"]


def test_text_equal_to_the_null_marker_fails(spark):
    df = spark.createDataFrame([("\\N",)], "a string")
    with pytest.raises(PySparkException, match="NULL marker"):
        write_artifact(df, work_dir(spark, "t"), fmt=CSV)
    assert roundtrip(df).first().a == "\\N"


def test_types_through_csv(spark):
    schema = (
        "i int, l long, d double, f float, b boolean, dec decimal(20,6), day date, ntz timestamp_ntz, "
        "ts timestamp, bin binary, arr array<string>, m map<string,int>, "
        "s struct<x:timestamp_ntz,y:array<double>>"
    )
    micro = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    rows = [
        (1, 2**62, 0.1, 0.5, True, Decimal("12345678901234.567891"), dt.date(1999, 12, 31), micro,
         micro.replace(tzinfo=dt.timezone.utc), bytearray(b"\x00\xff\n"), ["a", None, '"', ""],
         {"k": 1, "n": None}, (micro, [1.5, None])),
        (None,) * 13,
        (2, -1, -0.0, 1e-30, False, Decimal("0"), dt.date(2024, 2, 29), micro.replace(microsecond=0),
         micro.replace(tzinfo=dt.timezone.utc), bytearray(b""), [], {}, (None, [])),
    ]
    df = spark.createDataFrame(rows, schema)
    assertDataFrameEqual(roundtrip(df, fmt=CSV), df)


def test_counts_come_from_the_write(spark, small):
    events = load(spark, small, "events")
    for fmt in (PARQUET, CSV):
        written = write_artifact(events, work_dir(spark, "t"), fmt=fmt, watermark="ts")
        top = events.agg(F.max("ts").cast("string").alias("t")).first().t
        assert written == (events.count(), top)
        none = write_artifact(events.limit(0), work_dir(spark, "t"), fmt=fmt, watermark="ts")
        assert none == (0, None)


def test_partitioned_and_split_files(spark, small):
    customer = load(spark, small, "customer")
    path = work_dir(spark, "t")
    write_artifact(customer, path, partition_by=("c_mktsegment",), max_records=10)
    back = read_artifact(spark, path, customer.schema)
    same(back.select(customer.columns), customer)
    assert len(back.inputFiles()) >= customer.count() / 10


def test_an_artifact_is_never_overwritten_by_default(spark, small):
    path = work_dir(spark, "t")
    write_artifact(load(spark, small, "region"), path)
    with pytest.raises(PySparkException, match="(?i)already exists"):
        write_artifact(load(spark, small, "nation"), path)
    with pytest.raises(ValueError):
        write_artifact(load(spark, small, "region"), work_dir(spark, "t"), fmt="orc")


def test_overwriting_leaves_no_old_partition(spark):
    path, before = work_dir(spark, "t"), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for first in (0, 2):
            df = spark.range(first, 4).select("id", (F.col("id") % 10).alias("p"))
            write_artifact(df, path, partition_by=("p",), mode="overwrite")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert sorted(r.p for r in spark.read.parquet(path).collect()) == [2, 3]


def test_rows_are_counted_when_the_plan_turns_out_empty(spark):
    left, right = spark.range(100).filter("rand() < 0"), spark.range(100).filter("rand() >= 0")
    joined = left.hint("merge").join(right, "id")
    assert write_artifact(joined, work_dir(spark, "t")) == (0, None)
    assert write_artifact(spark.range(5).filter("false"), work_dir(spark, "t")).n_rows == 0
