"""Removing expired backup sets from their destinations."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.manifests import manifest_artifacts, manifest_location
from tidemark.workspace import Storage, materialise

DATA, MANIFEST = 0, 1
QUEUED = 4  # deletions waiting for each that runs


def removal_plan(expired: DataFrame) -> DataFrame:
    """Exactly what expired manifests list, then the manifests: `destination`, `step`, `path`."""
    data = manifest_artifacts(expired).select("destination", F.lit(DATA).alias("step"), "path")
    docs = expired.select(
        "destination", F.lit(MANIFEST).alias("step"), F.col("manifest").alias("path")
    )
    return data.unionByName(docs)


def _location(base: str, step: int, relative: str) -> str:
    if step == MANIFEST:
        base = manifest_location(base)
    parts = relative.strip("/").split("/")
    if not relative.strip("/") or any(p in ("", ".", "..") for p in parts):
        raise ValueError(f"refusing to delete {relative!r} below {base!r}")
    return f"{base.rstrip('/')}/{'/'.join(parts)}"


def remove_sets(
    spark: SparkSession,
    expired: DataFrame,
    bases: Mapping[str, str],
    dry_run: bool = True,
    max_parallel: int = 16,
) -> DataFrame:
    """Delete expired sets and return the plan that was, or with `dry_run` would be, carried out.

    The plan is stored first: the manifests it was made from are among what it deletes, and an
    interrupted run can be taken up from it with `carry_out`.
    """
    plan = materialise(removal_plan(expired), "removal")
    if not dry_run:
        carry_out(spark, plan, bases, max_parallel)
    return plan


def carry_out(spark: SparkSession, plan: DataFrame, bases: Mapping[str, str], max_parallel: int = 16) -> int:
    """Delete what a stored plan lists, all data before any manifest, and give how many paths that were.

    Each artifact is one folder and one call, whatever it holds. Paths stream to the driver one
    partition at a time and wait in a bounded queue: `max_parallel` deletions run at any moment, none
    waits for a slow one. What is gone already counts as deleted, so a plan can be repeated. The
    first failure is raised once those that run have ended, and then no manifest is touched.
    """
    storage, done = Storage(spark), 0
    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        for step in (DATA, MANIFEST):
            waiting: set[Future] = set()
            for row in plan.filter(F.col("step") == step).toLocalIterator(prefetchPartitions=True):
                waiting.add(pool.submit(storage.delete, _location(bases[row.destination], step, row.path)))
                if len(waiting) >= QUEUED * max_parallel:
                    ended, waiting = wait(waiting, return_when=FIRST_COMPLETED)
                    done += sum(f.result() is not None for f in ended)
            done += sum(f.result() is not None for f in waiting)
    return done
