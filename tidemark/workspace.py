"""Shared scratch space for intermediate tables, and small-file access through Hadoop."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_named: dict[str, str] = {}


def name_folder(path: str) -> None:
    """The folder of local sessions, whose executor is this process, that set no `spark.checkpoint.dir`."""
    _named["root"] = path


def _app_dir(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        root = _named.get("root")
    if not root:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return f"{root.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's part of the shared folder, which `spark.checkpoint.dir` names."""
    return f"{_app_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete all that this application put into the shared folder: at its end, when no result is read any more."""
    Storage(spark).delete(_app_dir(spark))


def materialise(df: DataFrame, label: str, *, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts lineage so that a lost executor costs a re-read, and gives the planner the exact size:
    a small result is then broadcast by its measured size and a large one is not.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialise` wrote. For tables whose every reader's result is written too:
    nothing that a lost executor takes with it is then made from them again."""
    for df in tables:
        folders = {f.rpartition("/")[0] for f in df.inputFiles()}
        for folder in folders:
            if "/tidemark/" not in folder:
                raise ValueError(f"{folder} is no intermediate table")
            Storage(df.sparkSession).delete(folder)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Many tables of the same columns as one. Halves are put together, not one after the other: each
    union is analysed with all below it, which would take the square of their number."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [frames[k : k + 2] for k in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


class Storage:
    """Small files and deletes on any Hadoop file system, from the driver."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.exists(p)

    def child_names(self, path: str) -> list[str]:
        fs, p = self._open(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def matching_names(self, pattern: str) -> list[str]:
        """Last path parts of what a glob finds."""
        return sorted(x.rpartition("/")[2] for x in self.matching_paths(pattern))

    def matching_paths(self, pattern: str) -> list[str]:
        """Paths that a glob finds: listed and matched in the JVM, and sent as one text, for which a job's
        input setting serves, since that takes an array of paths."""
        fs, p = self._open(pattern)
        found = fs.globStatus(p)
        if found is None or not len(found):
            return []
        hadoop = self._jvm.org.apache.hadoop
        job = hadoop.mapred.JobConf(self._conf)
        hadoop.mapred.FileInputFormat.setInputPaths(job, hadoop.fs.FileUtil.stat2Paths(found))
        joined = job.get("mapreduce.input.fileinputformat.inputdir")
        return sorted(re.sub(r"\\(.)", r"\1", x) for x in re.split(r"(?<!\\),", joined))

    def delete(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.delete(p, True)

    def read_text(self, path: str) -> str:
        """A small file, whole."""
        fs, p = self._open(path)
        source = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode("utf-8")
        finally:
            source.close()

    def write_text(self, path: str, text: str) -> None:
        """Create a new file whole: written under a hidden name, then renamed."""
        fs, p = self._open(path)
        if fs.exists(p):
            raise FileExistsError(path)
        hidden = self._jvm.org.apache.hadoop.fs.Path(
            p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}"
        )
        out = fs.create(hidden, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if not fs.rename(hidden, p):
            fs.delete(hidden, False)
            raise FileExistsError(path)
