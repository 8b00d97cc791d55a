"""Small JSON records that a run commits: manifests and resume state."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import SparkSession

from tidemark.functions.coordinates import Coordinate
from tidemark.functions.names import DRIVER_ABBREVIATIONS, MANIFEST_SUFFIX, sanitise_text
from tidemark.functions.stamps import iso, stamp
from tidemark.sources.manifests import manifest_location
from tidemark.sources.state import state_location
from tidemark.workspace import Storage


def set_token_text(at: datetime, note: str | None = None) -> str:
    tag = sanitise_text(note.strip()) if note else ""
    return stamp(at) + (f"_{tag}" if tag else "")


def manifest_name_text(database: str, driver: str, mode: str, token: str) -> str:
    return f"{sanitise_text(database)}_{DRIVER_ABBREVIATIONS[driver]}_{mode}_{token}{MANIFEST_SUFFIX}"


def write_manifest(spark: SparkSession, base: str, name: str, manifest: dict) -> str:
    """Write one manifest; its appearance is what makes a backup set visible."""
    path = f"{manifest_location(base)}/{name}"
    Storage(spark).write_text(path, json.dumps(manifest, indent=4, ensure_ascii=False))
    return path


def save_state(
    spark: SparkSession,
    state_path: str,
    connection: str,
    driver: str,
    set_id: str,
    saved_at: datetime,
    *,
    since: datetime | None = None,
    coordinate: Coordinate | None = None,
) -> None:
    """Append one state record; earlier ones stay as history."""
    record = {"connection": connection, "driver": driver, "set_id": set_id, "saved_utc": iso(saved_at)}
    if since is not None:
        record["since_utc"] = iso(since)
    if coordinate is not None:
        record |= coordinate._asdict()
    path = f"{state_location(state_path, connection, driver)}/{set_id}.json"
    Storage(spark).write_text(path, json.dumps(record, indent=4, ensure_ascii=False))
