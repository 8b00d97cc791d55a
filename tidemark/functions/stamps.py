"""Clock values: parsing, formatting and typed literals.

No function here reads the wall clock; callers pass the instant.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, functions as F, types as T

STAMP_FORMAT = "yyyyMMdd_HHmmss"
DEFAULT_WINDOW = timedelta(days=1)


def as_utc(value: datetime | date | str) -> datetime:
    """An aware UTC instant; text without an offset is taken as UTC."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def stamp(value: datetime | str) -> str:
    """`yyyyMMdd_HHmmss` in UTC."""
    return as_utc(value).strftime("%Y%m%d_%H%M%S")


def iso(value: datetime | str) -> str:
    return as_utc(value).isoformat()


def stamp_column(ts: Column) -> Column:
    """`stamp` of a column, whatever the session's time zone: a column with a zone is an instant,
    one without holds UTC clock time."""
    as_instant = F.to_utc_timestamp(ts, F.current_timezone())  # in the session's clock, UTC's digits
    shown = F.when(F.typeof(ts) == "timestamp", as_instant).otherwise(ts.cast("timestamp"))
    return F.date_format(shown, STAMP_FORMAT)


def cutoff_stamp(as_of: datetime | str, days: int) -> str:
    """Sets stamped before this text are older than `days` days."""
    return stamp(as_utc(as_of) - timedelta(days=days))


def utc_text(ts: Column, data_type: T.DataType) -> Column:
    """A watermark value as text in UTC clock time, whatever the session's time zone."""
    if isinstance(data_type, T.TimestampType):
        seconds = (F.unix_micros(ts) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
        ts = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)
    return ts.cast("string")


def typed_literal(value: datetime | str, data_type: T.DataType) -> Column:
    """The instant as a literal of the watermark column's own type, so that it can be pushed down.

    A DATE column compares at midnight, which cutting the instant to its date keeps exactly.
    """
    instant = as_utc(value)
    if isinstance(data_type, T.TimestampNTZType):
        text = instant.replace(tzinfo=None).isoformat(sep=" ")
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    if isinstance(data_type, T.TimestampType):
        text = instant.replace(tzinfo=None).isoformat(sep=" ")
        return F.expr(f"TIMESTAMP_LTZ '{text} UTC'")
    if isinstance(data_type, T.DateType):
        return F.expr(f"DATE '{instant.date().isoformat()}'")
    raise TypeError(f"a watermark column must be a timestamp or date, not {data_type.simpleString()}")
