"""Applying increments and change slices to a base table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.changes import DELETE_OPS, latest_changes
from tidemark.workspace import materialise

SHOWN_KEYS = 5


class InvalidKeyError(ValueError):
    """A key is NULL or not unique."""


def require_keys(df: DataFrame, keys: Sequence[str], label: str) -> None:
    """Fail when a key is NULL or repeated. Reads the key columns only."""
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    bad = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter((F.col("__n") > 1) | null_key)
        .limit(SHOWN_KEYS)
        .collect()
    )
    if bad:
        raise InvalidKeyError(f"{label}: NULL or repeated keys, e.g. {[tuple(r)[:-1] for r in bad]}")


def _same_columns(base: DataFrame, rows: DataFrame, allow_missing: bool) -> None:
    if not allow_missing and set(base.columns) != set(rows.columns):
        odd = sorted(set(base.columns) ^ set(rows.columns))
        raise ValueError(f"columns differ between base and increment: {odd}")


def _matching(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """The rows with, or without, a key that `other` has. NULL equals NULL."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"r.`{key}`").eqNullSafe(F.col(f"o.`{key}`"))
    return rows.alias("r").join(other.select(*keys).alias("o"), same, how)


def upsert(
    base: DataFrame,
    increment: DataFrame,
    keys: Sequence[str],
    *,
    allow_missing_columns: bool = False,
    check_keys: bool = True,
    check_base: bool = False,
) -> DataFrame:
    """Rows of the increment replace base rows with the same key; other rows stay or are added.

    An increment read from files is broadcast by Spark when its size is under the session's
    threshold, and then the base is not shuffled at all; a larger one is merge-joined. `check_keys`
    reads the increment's keys; `check_base` those of the base, which it has to shuffle.
    """
    _same_columns(base, increment, allow_missing_columns)
    if check_keys:
        require_keys(increment, keys, "increment")
    if check_base:
        require_keys(base, keys, "base")
    untouched = _matching(base, increment, keys, "left_anti")
    return untouched.unionByName(increment, allowMissingColumns=allow_missing_columns)


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    *,
    op_column: str = "op",
    delete_ops: Sequence[str] = DELETE_OPS,
    order: Sequence[str] = ("seq", "pos"),
    check_base: bool = False,
) -> DataFrame:
    """Apply a change slice in log order, deletes included. Change rows are full row images.

    The last change of each key is stored once: what it replaces and what it adds are read from there.
    `check_base` reads the base's keys, which it has to shuffle.
    """
    missing = set(base.columns) - set(changes.columns)
    if missing:
        raise ValueError(f"change rows lack columns of the base: {sorted(missing)}")
    if check_base:
        require_keys(base, keys, "base")
    latest = materialise(latest_changes(changes, keys, order), "latest")
    kept = latest.filter(~F.coalesce(F.col(op_column).isin(list(delete_ops)), F.lit(False)))
    untouched = _matching(base, latest, keys, "left_anti")
    return untouched.unionByName(kept.select(*base.columns))


def _touched(target: DataFrame, touched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of `target` in touched partitions, read from these alone where it is stored by `columns`.

    Partitions without a NULL are met by equality with the stored rows of `touched`. Spark then runs
    those first and prunes the scan by them, one by one, if they are few enough to be broadcast; it
    does so only for a side with a filter, and that is what `hit` is for. Partitions with a NULL are
    a branch of their own, whose filter prunes all others when the plan is made.
    """
    null = F.lit(False)
    for name in columns:
        null = null | F.col(f"`{name}`").isNull()
    hit = touched.filter(F.col("hit") == 1)
    same = F.lit(True)
    for name in columns:
        same = same & (F.col(f"r.`{name}`") == F.col(f"o.`{name}`"))
    met = target.alias("r").join(hit.alias("o"), same, "left_semi")
    return met.unionByName(_matching(target.filter(null), touched.filter(null), columns, "left_semi"))


def upsert_partitions(
    target: DataFrame,
    increment: DataFrame,
    keys: Sequence[str],
    partition_keys: Sequence[str],
    *,
    check_keys: bool = True,
    check_base: bool = False,
) -> DataFrame:
    """The new content of just those partitions of `target` that the increment touches.

    The partition columns must be part of the key, so that no row can change partition. Of a target
    stored by these columns only the touched partitions are read, however they are scattered.
    """
    if not set(partition_keys) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    if "hit" in partition_keys:
        raise ValueError("a partition column may not be named hit")
    touched = increment.select(*partition_keys).distinct().withColumn("hit", F.lit(1))
    affected = _touched(target, materialise(touched, "touched-partitions"), partition_keys)
    return upsert(affected, increment, keys, check_keys=check_keys, check_base=check_base)
