"""Writing and reading table artifacts: parquet by default, CSV for interchange."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.stamps import utc_text

PARQUET = "parquet"
CSV = "csv"
FORMATS = (PARQUET, CSV)

# A value no text column may hold: NULL and the empty string stay apart in CSV.
NULL_VALUE = r"\N"
TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": NULL_VALUE,
    **TIME_OPTIONS,
}
JSON_OPTIONS = {"ignoreNullFields": "false", **TIME_OPTIONS}
# A CSV file with line breaks inside values cannot be split when read: one input split's rows
# make one file, and this bounds it where a shuffle came before.
CSV_MAX_RECORDS = 1_000_000


class Written(NamedTuple):
    n_rows: int
    max_watermark: str | None


def _is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ArrayType, T.MapType, T.StructType))


def _to_text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if _is_nested(field.dataType):
        return F.to_json(column, JSON_OPTIONS).alias(field.name)
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(column).alias(field.name)
    if isinstance(field.dataType, T.StringType):
        clash = F.raise_error(F.lit(f"column {field.name} holds the NULL marker {NULL_VALUE}"))
        return F.when(column == NULL_VALUE, clash.cast("string")).otherwise(column).alias(field.name)
    return column


def _from_text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if _is_nested(field.dataType):
        return F.from_json(column, field.dataType, JSON_OPTIONS).alias(field.name)
    if isinstance(field.dataType, T.BinaryType):
        return F.unhex(column).alias(field.name)
    return column


def _csv_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(f.name, T.StringType())
            if _is_nested(f.dataType) or isinstance(f.dataType, T.BinaryType)
            else T.StructField(f.name, f.dataType)
            for f in schema.fields
        ]
    )


def write_artifact(
    df: DataFrame,
    path: str,
    *,
    fmt: str = PARQUET,
    compression: str | None = None,
    watermark: str | None = None,
    partition_by: Sequence[str] = (),
    max_records: int | None = None,
    mode: str = "errorifexists",
) -> Written:
    """Write one artifact; rows and highest watermark are observed by the writing job itself.

    The observation sits directly under the write, in its last stage, where Spark counts each
    task once however often tasks or executors are lost.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    seen = Observation()
    top = F.lit(None).cast("string")
    if watermark is not None:
        top = utc_text(F.max(watermark), df.schema[watermark].dataType)
    body = df.select([_to_text(f) for f in df.schema.fields]) if fmt == CSV else df
    body = body.observe(seen, F.count(F.lit(1)).alias("n_rows"), top.alias("max_watermark"))
    # Overwriting replaces the whole artifact, also where the session would keep other partitions.
    writer = body.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression is not None:
        writer = writer.option("compression", compression)
    if max_records is None and fmt == CSV:
        max_records = CSV_MAX_RECORDS
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", max_records)
    if fmt == CSV:
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.parquet(path)
    values = seen.get
    return Written(values["n_rows"], values["max_watermark"])


def read_artifact(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    *,
    fmt: str = PARQUET,
    base_path: str | None = None,
    set_as: str | None = None,
) -> DataFrame:
    """Read artifacts back with their declared schema; nothing is inferred. `set_as` names a column
    for the set that each row's path names."""
    token = [] if set_as is None else [F.regexp_extract("_metadata.file_path", "/set=([^/]+)/", 1).alias(set_as)]
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    if fmt == PARQUET:
        return with_marks(reader.schema(schema).parquet(*paths).select(*[F.col(f"`{n}`") for n in schema.names], *token), schema)
    if fmt != CSV:
        raise ValueError(f"unknown format {fmt!r}")
    text = (
        reader.schema(_csv_schema(schema))
        .options(**CSV_OPTIONS)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .csv(paths)
    )
    return with_marks(text.select([*[_from_text(f) for f in schema.fields], *token]), schema)


def with_marks(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared schema's column metadata, which readers drop for partition columns."""
    for field in schema.fields:
        if field.metadata and df.schema[field.name].metadata != field.metadata:
            df = df.withMetadata(field.name, field.metadata)
    return df
