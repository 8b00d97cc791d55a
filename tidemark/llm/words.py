"""Words as the operators count them: runs of anything but space, tab, line ends and the like."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` mentions it."""
    return F.transform(F.array(value), use)[0]
