"""Where every artifact goes at every destination."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.names import join_path
from tidemark.functions.options import base_path, destination_map, parse_destination_map


def _literal_map(mapping: Mapping[str, str]) -> Column:
    pairs = [F.lit(text) for item in mapping.items() for text in item]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def placement_plan(
    artifacts: DataFrame,
    disks: Sequence[str],
    mapping: str | Mapping[str, str] | Column | None = None,
    fallback: str = "",
    path_column: str = "path",
) -> DataFrame:
    """Each artifact once per destination, with `disk`, `base_path` and `remote_path`.

    The destinations are part of each row's expression: no join, no shuffle.
    A column given as `mapping` holds option text; anything else is parsed here.
    """
    if isinstance(mapping, Column):
        lookup = destination_map(mapping)
    else:
        lookup = _literal_map(parse_destination_map(mapping))
    placed = artifacts.withColumn("disk", F.explode(F.array(*[F.lit(d) for d in disks])))
    placed = placed.withColumn("base_path", base_path(F.col("disk"), lookup, F.lit(fallback)))
    return placed.withColumn("remote_path", join_path(F.col("base_path"), F.col(path_column)))


def destination_bases(
    disks: Mapping[str, str], mapping: str | Mapping[str, str] | None = None, fallback: str = ""
) -> dict[str, str]:
    """Full base location of each disk: its root plus its mapped path, or plus the fallback."""
    lookup = parse_destination_map(mapping)
    out = {}
    for disk, root in disks.items():
        base = lookup.get(disk, fallback.strip("/"))
        out[disk] = "/".join(p for p in (root.rstrip("/"), base) if p)
    return out
