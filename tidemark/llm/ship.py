"""Sends this package to the executors, whose Python workers import the operators from it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import tidemark

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application; the driver serves the file, however the executors were started."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    top = Path(tidemark.__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark-code.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(top.rglob("*.py")):
            out.write(source, source.relative_to(top.parent))
    context.addPyFile(str(path))
    _sent.add(context.applicationId)
