"""The most frequent rows of a table of counts, found without sorting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def most_frequent(counts: DataFrame, column: str, limit: int) -> DataFrame:
    """Rows of the greatest counts, at most `limit`: all of at least some count, eight steps to a doubling."""
    level = F.floor(F.log2(F.col(column)) * 8)
    sizes = counts.groupBy(level.alias("level")).count().collect()  # at most 512 rows
    total, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        total += row["count"]
        if total > limit:
            break
        least = row["level"]
    return counts.filter(F.lit(False) if least is None else level >= least)
