"""Placing a written artifact at further destinations."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession, types as T

from tidemark.sinks.formats import read_artifact, write_artifact

In = TypeVar("In")
Out = TypeVar("Out")


def run_jobs(
    spark: SparkSession, work: Callable[[In], Out], items: Iterable[In], max_parallel: int
) -> list[Out]:
    """Submit independent Spark jobs from a small thread pool and return results in order.

    The first failure is raised once the jobs already running have ended; waiting ones are dropped.
    """
    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]
        try:
            return [f.result() for f in futures]
        except BaseException:
            for f in futures:
                f.cancel()
            raise


def copy_artifact(
    spark: SparkSession,
    source: str,
    targets: Sequence[str],
    schema: T.StructType,
    *,
    fmt: str,
    compression: str | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    """Copy one artifact to other locations from what was written first, so that all agree."""
    written = read_artifact(spark, source, schema, fmt=fmt)
    for target in targets:
        write_artifact(
            written, target, fmt=fmt, compression=compression, partition_by=partition_by, mode=mode
        )
