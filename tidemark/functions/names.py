"""Column expressions over backup-set names, identifiers and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The name format of manifests and identifiers is part of the data model.
TOKEN_PATTERN = r"_(\d{8}_\d{6}(?:_[A-Za-z0-9._-]+)?)\.manifest\.json$"
STAMP_LENGTH = 15
UNSAFE_CHARS = r"[^A-Za-z0-9._-]+"
MANIFEST_SUFFIX = ".manifest.json"
DRIVER_ABBREVIATIONS = {"pgsql": "pg", "mysql": "my"}
DRIVER_ALIASES = {"pgsql": "pgsql", "mysql": "mysql", "mariadb": "mysql"}


def set_token(manifest_name: Column) -> Column:
    """Token of a manifest name, NULL where the name carries none."""
    return F.nullif(F.regexp_extract(manifest_name, TOKEN_PATTERN, 1), F.lit(""))


def set_ts(token: Column) -> Column:
    """The `yyyyMMdd_HHmmss` part of a token."""
    return F.substring(token, 1, STAMP_LENGTH)


def sanitise(identifier: Column) -> Column:
    """Replace every run of characters unsafe in a path by one dash."""
    return F.regexp_replace(identifier, UNSAFE_CHARS, "-")


def sanitise_text(identifier: str) -> str:
    return re.sub(UNSAFE_CHARS, "-", identifier)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def trim_slashes(path: Column) -> Column:
    return F.btrim(path, F.lit("/"))


def join_path(*parts: Column) -> Column:
    """Join parts with `/`, leaving out parts that are empty after trimming slashes."""
    trimmed = F.array(*[trim_slashes(p) for p in parts])
    return F.concat_ws("/", F.filter(trimmed, lambda p: p != ""))


def canonical_driver(driver: Column) -> Column:
    """Lower-cased driver with aliases folded; NULL when it is not supported."""
    lowered = F.lower(driver)
    out = F.lit(None).cast("string")
    for alias, name in DRIVER_ALIASES.items():
        out = F.when(lowered == alias, F.lit(name)).otherwise(out)
    return out


def driver_abbreviation(driver: Column) -> Column:
    canonical = canonical_driver(driver)
    out = F.lit(None).cast("string")
    for name, short in DRIVER_ABBREVIATIONS.items():
        out = F.when(canonical == name, F.lit(short)).otherwise(out)
    return out


def manifest_name(
    database: Column, driver: Column, mode: Column, stamp: Column, note: Column | None = None
) -> Column:
    """`{database}_{pg|my}_{mode}_{stamp}[_{note}].manifest.json`."""
    parts = [sanitise(database), driver_abbreviation(driver), F.lower(mode), stamp]
    if note is not None:
        # concat_ws leaves out a part that is NULL.
        parts.append(F.nullif(sanitise(F.trim(note)), F.lit("")))
    return F.concat(F.concat_ws("_", *parts), F.lit(MANIFEST_SUFFIX))


def artifact_path(
    database: Column, mode: Column, token: Column, schema_name: Column, table_name: Column
) -> Column:
    """Path of one table's output below a destination base.

    All sets of a table lie side by side, so several of them read as one partitioned table.
    """
    return F.concat_ws(
        "/",
        sanitise(database),
        sanitise(mode),
        sanitise(schema_name),
        sanitise(table_name),
        F.concat(F.lit("set="), token),
    )
