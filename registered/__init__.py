"""Queries over the test tables, each with the SQL that gives the same rows."""

from registered import changes, incremental, restore, retention, selection, snapshots, streaming
from registered.common import Query

MODULES = (incremental, selection, snapshots, changes, restore, retention, streaming)


def queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.R.queries.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.R.oracles.items()}
