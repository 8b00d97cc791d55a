"""Wildcard patterns over `schema.table` names."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F


def wildcard_regex(wildcard: str) -> str:
    """Anchored, case-insensitive regex; `*` is the only wildcard."""
    return "(?i)^" + ".*".join(re.escape(part) for part in wildcard.split("*")) + "$"


def split_pattern(pattern: str) -> tuple[str, str]:
    """Split on the first dot; a pattern without a dot means any schema."""
    schema, dot, table = pattern.partition(".")
    return (schema, table) if dot else ("*", pattern)


def matches_any(schema_name: Column, table_name: Column, patterns: Iterable[str]) -> Column:
    """True where a name matches at least one pattern: one predicate, no join."""
    tests = []
    for pattern in patterns:
        schema, table = split_pattern(pattern)
        tests.append(
            schema_name.rlike(wildcard_regex(schema)) & table_name.rlike(wildcard_regex(table))
        )
    return reduce(lambda a, b: a | b, tests, F.lit(False))
