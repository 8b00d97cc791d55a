"""Option texts: comma lists, destination maps, numbers.

The column forms parse options held in a table; the plain forms parse the arguments of one run.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from tidemark.functions.names import trim_slashes


# Fixed value: the characters that count as blank around an option.
BLANKS = " \t\n\r\0\x0b"


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def csv_list(text: Column) -> Column:
    """Split on commas, trim, drop empty items; NULL gives an empty array."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: _strip(x))
    return F.filter(parts, lambda x: x != "")


def destination_map(text: Column) -> Column:
    """`{"disk": "path"}` or `disk:path,disk:path` as map<string,string>, slashes trimmed.

    The first colon splits a pair; a pair without a colon is left out; an empty path stays.
    """
    body = _strip(F.coalesce(text, F.lit("")))
    pairs = F.filter(csv_list(body), lambda p: F.contains(p, F.lit(":")))
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            _strip(F.substring_index(p, ":", 1)).alias("key"),
            _strip(F.substr(p, F.position(F.lit(":"), p) + 1)).alias("value"),
        ),
    )
    # A disk named twice keeps its last path.
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = F.map_from_entries(
        F.transform(
            keys,
            lambda k: F.struct(
                k.alias("key"),
                F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value"),
            ),
        )
    )
    parsed = F.from_json(body, "map<string,string>")
    chosen = F.when(F.startswith(body, F.lit("{")), parsed).otherwise(last)
    return F.transform_values(chosen, lambda _, v: trim_slashes(F.coalesce(v, F.lit(""))))


def base_path(disk: Column, mapping: Column, fallback: Column) -> Column:
    """Mapped path of a disk, else the fallback. An empty mapped path means the root."""
    return trim_slashes(
        F.when(F.map_contains_key(mapping, disk), F.try_element_at(mapping, disk)).otherwise(fallback)
    )


def non_negative_int(text: Column) -> Column:
    """NULL or blank stays NULL; anything but a whole number >= 0 fails the query."""
    cleaned = _strip(text.cast("string"))
    number = cleaned.try_cast("int")
    bad = F.raise_error(F.concat(F.lit("not a non-negative whole number: "), cleaned)).cast("int")
    return (
        F.when(F.coalesce(cleaned, F.lit("")) == "", F.lit(None).cast("int"))
        .when(cleaned.rlike(r"^\d+$") & number.isNotNull(), number)
        .otherwise(bad)
    )


def parse_list(value: str | Iterable[str] | None) -> list[str]:
    if value is None:
        return []
    items = value.split(",") if isinstance(value, str) else value
    return [item.strip(BLANKS) for item in items if item.strip(BLANKS) != ""]


def parse_destination_map(value: str | Mapping[str, str] | None) -> dict[str, str]:
    if value is None or isinstance(value, str) and value.strip(BLANKS) == "":
        return {}
    if isinstance(value, str) and value.strip(BLANKS).startswith("{"):
        value = json.loads(value)
    if isinstance(value, Mapping):
        return {str(disk): str(path or "").strip("/") for disk, path in value.items()}
    split = [item.partition(":") for item in parse_list(value)]
    return {disk.strip(BLANKS): path.strip(BLANKS).strip("/") for disk, colon, path in split if colon}


def parse_count(value: int | str | None, name: str) -> int | None:
    """Retention numbers: a typo must never become 0, which would delete everything."""
    if value is None or (isinstance(value, str) and value.strip(BLANKS) == ""):
        return None
    text = str(value).strip(BLANKS)
    if isinstance(value, bool) or not (text.isascii() and text.isdigit()):
        raise ValueError(f"{name} must be a non-negative whole number, got {value!r}")
    return int(text)
