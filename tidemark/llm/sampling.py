"""Bounds on hashes, for samples drawn by hash."""

from __future__ import annotations

RANGE = 1 << 63  # of hashes without their sign


def hash_bound(wanted: int, total: int) -> int:
    """The bound under which about `wanted` of `total` hashes lie. It keeps apart any numbers of rows
    that a table can hold: of 1e11 rows, 3,000 lie below 2.8e11."""
    return RANGE - 1 if wanted >= total else max(1, RANGE * wanted // total) - 1
