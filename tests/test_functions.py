"""Scalar functions: names, options, patterns, clock values, coordinates."""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from tidemark.functions import names, options, patterns, stamps
from tidemark.functions.coordinates import Coordinate, log_seq
from tidemark.operators.selection import schema_set, select_schemas, select_tables


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


@pytest.mark.parametrize("name, token", [
    ("db_pg_full_20240101_010101.manifest.json", "20240101_010101"),
    ("db_pg_full_20240101_010101_pre-1.x.manifest.json", "20240101_010101_pre-1.x"),
    ("db_20200101_000000_pg_full_20240101_010101.manifest.json",
     "20200101_000000_pg_full_20240101_010101"),
    ("db_pg_full_20240101_010101.json", None),
    ("db_pg_full_2024010_010101.manifest.json", None),
    ("db_pg_full_20240101_010101_a b.manifest.json", None),
])
def test_tokens(spark, name, token):
    row = texts(spark, [name]).select(
        names.set_token(F.col("t")).alias("token"),
        names.set_ts(names.set_token(F.col("t"))).alias("ts"),
    ).first()
    assert row.token == token
    assert row.ts == (token and token[:15])


def test_name_pieces(spark):
    assert one(spark, names.sanitise(F.lit("a b/c:é.d-e_f"))) == "a-b-c-.d-e_f"
    assert one(spark, names.basename(F.lit("x/y/z.csv"))) == "z.csv"
    assert one(spark, names.basename(F.lit("z.csv"))) == "z.csv"
    assert one(spark, names.join_path(F.lit("/a/b/"), F.lit(""), F.lit("c"))) == "a/b/c"
    assert one(spark, names.join_path(F.lit(""), F.lit("c"))) == "c"
    assert one(spark, names.canonical_driver(F.lit("MariaDB"))) == "mysql"
    assert one(spark, names.canonical_driver(F.lit("oracle"))) is None
    assert one(spark, names.manifest_name(
        F.lit("shop"), F.lit("mariadb"), F.lit("FULL"), F.lit("20240101_010101"), F.lit(" a b ")
    )) == "shop_my_full_20240101_010101_a-b.manifest.json"
    assert one(spark, names.manifest_name(
        F.lit("shop"), F.lit("pgsql"), F.lit("full"), F.lit("20240101_010101")
    )) == "shop_pg_full_20240101_010101.manifest.json"


def test_lists(spark):
    df = texts(spark, [" a, b,,c ,", "", None]).select(options.csv_list(F.col("t")).alias("x"))
    assert [r.x for r in df.collect()] == [["a", "b", "c"], [], []]
    assert options.parse_list(" a, b,,c ,") == ["a", "b", "c"]
    assert options.parse_list(None) == []


@pytest.mark.parametrize("text, expected", [
    ("near:arc/one,far:", {"near": "arc/one", "far": ""}),
    (' {"near":"/arc/one/","far":""}', {"near": "arc/one", "far": ""}),
    ("near:a:b, far : /x/ ,junk", {"near": "a:b", "far": "x"}),
    ("near:a,near:b", {"near": "b"}),
    ("", {}),
])
def test_destination_maps(spark, text, expected):
    assert options.parse_destination_map(text) == expected
    row = texts(spark, [text]).select(options.destination_map(F.col("t")).alias("m")).first()
    assert row.m == expected


def test_base_path_prefers_the_map_and_keeps_empty(spark):
    mapping = options.destination_map(F.lit('{"near":"arc/one","far":""}'))
    got = {
        disk: one(spark, options.base_path(F.lit(disk), mapping, F.lit("spare/y")))
        for disk in ("near", "far", "vault")
    }
    assert got == {"near": "arc/one", "far": "", "vault": "spare/y"}


def test_counts_are_strict(spark):
    assert options.parse_count("7", "keep") == 7
    assert options.parse_count(0, "keep") == 0
    assert options.parse_count(" ", "keep") is None
    for bad in ("seven", "7d", "-1", -1, "1.5", True):
        with pytest.raises(ValueError):
            options.parse_count(bad, "keep")
    good = texts(spark, ["12", "", None]).select(options.non_negative_int(F.col("t")).alias("x"))
    assert [r.x for r in good.collect()] == [12, None, None]
    for bad in ("seven", "-1", "99999999999"):
        with pytest.raises(PySparkException, match="not a non-negative whole number"):
            texts(spark, [bad]).select(options.non_negative_int(F.col("t")).alias("x")).collect()


def matches(schema, table, pats):
    """Plain model: the first dot splits, `*` is any text, case does not count."""
    for pat in pats:
        ps, pt = pat.split(".", 1) if "." in pat else ("*", pat)
        hit = [
            re.fullmatch(".*".join(map(re.escape, w.lower().split("*"))), v.lower())
            for w, v in ((ps, schema), (pt, table))
        ]
        if all(hit):
            return True
    return False


@pytest.mark.parametrize("include, exclude", [
    ([], []), (["public.orders"], []), (["ORDERS"], []), (["*.o*", "audit.*"], ["*.orders"]),
    (["public.*"], ["public.*"]), (["a.b.c"], []), (["pub?ic.*", "[a-z]*"], []), (["x\\*"], []),
    ([], ["*_log"]),
])
def test_table_patterns(spark, include, exclude):
    tables = [
        ("public", "orders"), ("public", "Order_Items"), ("audit", "event_log"), ("a", "b.c"),
        ("pubXic", "t"), ("public", "x\\y"), ("o", "o"), ("sales", "orders"),
    ]
    df = spark.createDataFrame(tables, "schema_name string, table_name string")
    got = {tuple(r) for r in select_tables(df, include, exclude).collect()}
    want = {
        (s, t) for s, t in tables
        if (not include or matches(s, t, include)) and not matches(s, t, exclude)
    }
    assert got == want


def test_schema_filters_are_exact(spark):
    df = texts(spark, ["a", "B", "c", "d"]).toDF("schema_name")
    got = select_schemas(df, "a,b,c", "c")
    assert {r.schema_name for r in got.collect()} == {"a"}
    assert {r.schema_name for r in schema_set(spark, df, ["a", "b", "c"], ["c"]).collect()} == {"a"}
    assert select_schemas(df).count() == 4


def test_instants():
    noon = datetime(2025, 9, 30, 10, tzinfo=timezone.utc)
    assert stamps.as_utc("2025-09-30T12:00:00+02:00") == noon
    assert stamps.as_utc("2025-09-30T10:00:00Z") == noon
    assert stamps.as_utc(datetime(2025, 9, 30, 10)) == noon
    assert stamps.stamp("2025-09-30T12:00:05+02:00") == "20250930_100005"
    assert stamps.cutoff_stamp("2024-03-01T00:00:00", 1) == "20240229_000000"
    assert stamps.as_utc(date(2025, 9, 30)) == datetime(2025, 9, 30, tzinfo=timezone.utc)


def test_typed_literals_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        literal = stamps.typed_literal("2025-09-30T12:00:00+02:00", T.TimestampType())
        assert one(spark, F.unix_seconds(literal)) == 1759226400
        literal = stamps.typed_literal("2025-09-30T12:00:00.000001+02:00", T.TimestampNTZType())
        assert one(spark, literal.cast("string")) == "2025-09-30 10:00:00.000001"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    with pytest.raises(TypeError):
        stamps.typed_literal("2025-09-30", T.StringType())


def test_log_names_sort_by_number(spark):
    files = ["mysql-bin.000010", "mysql-bin.000009", "mysql-bin.1000000"]
    ordered = texts(spark, files).orderBy(log_seq(F.col("t"))).collect()
    assert [r.t for r in ordered] == ["mysql-bin.000009", "mysql-bin.000010", "mysql-bin.1000000"]
    assert Coordinate("mysql-bin.000010", 4).order == (10, 4)
    with pytest.raises(PySparkException, match="no numeric suffix"):
        texts(spark, ["mysql-bin"]).select(log_seq(F.col("t"))).collect()
    with pytest.raises(ValueError):
        Coordinate("mysql-bin", 4).seq


def test_stamp_column_agrees_with_stamp_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            instant = F.expr("TIMESTAMP_LTZ '2024-01-01 00:00:00 UTC'")
            plain = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
            assert one(spark, stamps.stamp_column(instant)) == one(spark, stamps.stamp_column(plain)) == stamps.stamp("2024-01-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
