"""Coordinates of an ordered change log: (file, position), ordered by (seq, position)."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, functions as F

SEQ_PATTERN = r"(\d+)$"
# Fixed value: the first event of every log file starts here.
FIRST_POSITION = 4


class Coordinate(NamedTuple):
    file: str
    pos: int

    @property
    def seq(self) -> int:
        found = re.search(SEQ_PATTERN, self.file)
        if found is None:
            raise ValueError(f"log file name has no numeric suffix: {self.file!r}")
        return int(found.group(1))

    @property
    def order(self) -> tuple[int, int]:
        return self.seq, self.pos


def log_seq(file: Column) -> Column:
    """Numeric suffix of a log file name; a name without one fails the query."""
    number = F.regexp_extract(file, SEQ_PATTERN, 1).try_cast("bigint")
    bad = F.raise_error(F.concat(F.lit("log file name has no numeric suffix: "), file)).cast("bigint")
    return F.coalesce(number, bad)


def in_range(seq: Column, pos: Column, start: Coordinate, end: Coordinate) -> Column:
    """Half-open [start, end). The BETWEEN on `seq` alone is what prunes partitions."""
    s0, p0 = start.order
    s1, p1 = end.order
    return (
        seq.between(s0, s1)
        & ((seq > s0) | (pos >= p0))
        & ((seq < s1) | (pos < p1))
    )
