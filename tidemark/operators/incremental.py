"""Watermark extracts: the rows of a table changed since an instant."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.stamps import DEFAULT_WINDOW, as_utc, typed_literal, utc_text
from tidemark.workspace import union_all


class Window(NamedTuple):
    """Extracted range: after `since`, up to and including `upper`."""

    since: datetime
    upper: datetime


def resume_window(
    upper: datetime | str,
    *,
    since: datetime | str | None = None,
    saved: datetime | str | None = None,
    lookback: timedelta = timedelta(0),
) -> Window:
    """Explicit `since`, else the saved state, else one day before `upper`.

    `upper` is fixed before any table is read and becomes the next `since`, so rows committed
    during the run fall into the next one. `lookback` re-reads an interval before a saved state
    for rows that arrive late; restoring by key makes the repeats harmless.
    """
    upper = as_utc(upper)
    if since is not None:
        return Window(as_utc(since), upper)
    if saved is not None:
        return Window(as_utc(saved) - lookback, upper)
    return Window(upper - DEFAULT_WINDOW, upper)


def incremental_extract(
    df: DataFrame, column: str, since: datetime | str, upper: datetime | str | None = None
) -> DataFrame:
    """Rows with `since < column <= upper`; rows whose watermark is NULL are never extracted.

    Both bounds are literals of the column's own type, so the filter reaches the scan.
    """
    data_type = df.schema[column].dataType
    rows = df.filter(F.col(column) > typed_literal(since, data_type))
    if upper is not None:
        rows = rows.filter(F.col(column) <= typed_literal(upper, data_type))
    return rows


def extract_summary(extracts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and highest watermark of each `{table: (extract, watermark column)}`."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(column).alias("max_watermark")).select(
            F.lit(name).alias("table_name"), "n_rows", "max_watermark"
        )
        for name, (df, column) in extracts.items()
    ]
    return union_all(rows)


def highest_watermark(df: DataFrame, column: str) -> datetime | None:
    """The single highest watermark value as an aware UTC instant."""
    row = df.agg(utc_text(F.max(column), df.schema[column].dataType).alias("top")).first()
    return as_utc(row.top) if row.top is not None else None
