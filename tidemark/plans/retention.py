"""Retention over the manifests found at a set of destinations."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.retention import expired_sets
from tidemark.sinks.removal import remove_sets
from tidemark.sources.manifests import manifest_location, read_manifests
from tidemark.workspace import Storage, union_all


def all_manifests(
    spark: SparkSession, bases: Mapping[str, str], *,
    database: str | None = None, driver: str | None = None, mode: str | None = None,
) -> DataFrame | None:
    """Manifests of every destination that has any; of one database or family, only its own are opened."""
    storage = Storage(spark)
    found = [
        read_manifests(spark, base, disk, database=database, driver=driver, mode=mode)
        for disk, base in bases.items()
        if storage.exists(manifest_location(base))
    ]
    return union_all(found) if found else None


def apply_retention(
    spark: SparkSession,
    bases: Mapping[str, str],
    *,
    keep: int | str | None = None,
    days: int | str | None = None,
    as_of: datetime | str | None = None,
    database: str | None = None,
    driver: str | None = None,
    mode: str | None = None,
    dry_run: bool = True,
) -> DataFrame | None:
    """Expire sets per destination and family; families are told apart by exact columns.

    Returns the removal plan, or None when there is nothing to look at.
    """
    if keep is None and days is None:
        return None
    manifests = all_manifests(
        spark, bases, database=database, driver=driver if database else None, mode=mode if database and driver else None
    )
    if manifests is None:
        return None
    for name, value in (("database", database), ("driver", driver), ("mode", mode)):
        if value is not None:
            manifests = manifests.filter(F.col(name) == value)
    return remove_sets(
        spark, expired_sets(manifests, keep=keep, days=days, as_of=as_of), bases, dry_run
    )
