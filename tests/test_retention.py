"""Retention against a plain model of the rule, on random and on lopsided manifest sets."""

from __future__ import annotations

import random
import re

import pytest

from tidemark.operators.retention import expired_sets, expired_tokens, flag_expired
from tidemark.sources.manifests import with_tokens

AS_OF = "2024-01-11T00:00:00"
CUTOFF = {0: "20240111_000000", 3: "20240108_000000", 9999: "19960826_000000"}


def model(names, keep, days):
    """By the definition: a set expires if at least `keep` sets of its family are newer by time and then
    by name, or if its time lies before the cutoff. A name without a token never expires."""
    sets = [(m[1], name) for name in names if (m := re.search(r"_([0-9]{8}_[0-9]{6})(_[\w.-]+)?\.manifest\.json$", name))]
    surplus = {
        name for at, name in sets
        if keep is not None and keep >= 0 and sum(other > (at, name) for other in sets) >= keep
    }
    return surplus | {name for at, name in sets if days is not None and at < CUTOFF[days]}


def frame(spark, families):
    rows = [
        ("s3", db, "pgsql", "full", name) for db, names in families.items() for name in names
    ]
    return with_tokens(spark.createDataFrame(
        rows, "destination string, database string, driver string, mode string, manifest string"
    ))


def random_family(rng, db, size):
    names = set()
    while len(names) < size:
        day, second = rng.randint(1, 12), rng.randint(0, 3)
        note = rng.choice(["", "", "_n", f"_x{rng.randint(0, 9)}", "_bad note"])
        end = rng.choice([".manifest.json"] * 5 + [".json"])
        names.add(f"{db}_pg_full_202401{day:02d}_00000{second}{note}{end}")
    return names


@pytest.mark.parametrize("keep, days", [
    (None, None), (0, None), (1, None), (3, None), (50, None), (-1, None), (None, 0), (None, 3),
    (None, 9999), (3, 3), (-1, 3), (5, 0),
])
def test_matches_model(spark, keep, days):
    rng = random.Random(hash((keep, days)) & 0xFFFF)
    families = {f"db{i}": random_family(rng, f"db{i}", size) for i, size in enumerate([1, 4, 40, 120])}
    got = expired_sets(frame(spark, families), keep=keep, days=days, as_of=AS_OF)
    want = {n for names in families.values() for n in model(names, keep, days)}
    assert {r.manifest for r in got.collect()} == want


def test_tokens_of_expired_sets(spark):
    names = [f"shop_my_full_{d}_233000.manifest.json" for d in ("20230305", "20230306", "20240229", "20240301")]
    got = expired_tokens(expired_sets(frame(spark, {"shop": names}), keep=2))
    assert sorted(r.set_token for r in got.collect()) == ["20230305_233000", "20230306_233000"]


@pytest.mark.parametrize("keep", [10, 100, 101, 1500])
def test_one_family_holds_most_rows(spark, keep):
    names = [
        f"hot_pg_full_202401{1 + i % 3:02d}_{i % 24:02d}{i % 60:02d}00_{i:05d}.manifest.json"
        for i in range(4000)
    ]
    families = {"hot": names} | {f"db{i}": names[i : i + 2] for i in range(20)}
    got = expired_sets(frame(spark, families), keep=keep)
    assert {(r.database, r.manifest) for r in got.collect()} == {
        (db, n) for db, ns in families.items() for n in model(ns, keep, None)
    }


def test_missing_family_values_are_a_family(spark):
    rows = [("s3", None, "pgsql", "full", f"x_pg_full_2024010{i}_000000.manifest.json") for i in (1, 2)]
    sets = with_tokens(spark.createDataFrame(
        rows, "destination string, database string, driver string, mode string, manifest string"
    ))
    assert [r.set_ts for r in expired_sets(sets, keep=1).collect()] == ["20240101_000000"]


def test_flags_tell_the_rules_apart(spark):
    names = [f"db_pg_full_202401{d:02d}_000000.manifest.json" for d in (1, 9, 10)]
    rows = flag_expired(frame(spark, {"db": names}), keep=1, days=3, as_of=AS_OF).collect()
    assert {r.set_ts[:8]: (r.by_keep, r.by_age, r.expired) for r in rows} == {
        "20240101": (True, True, True), "20240109": (True, False, True),
        "20240110": (False, False, False),
    }


def test_bad_policies_fail(spark):
    sets = frame(spark, {"db": ["db_pg_full_20240101_000000.manifest.json"]})
    for policy in ({"keep": "ten"}, {"days": "x", "as_of": AS_OF}, {"days": 3}, {"keep": True}):
        with pytest.raises(ValueError):
            expired_sets(sets, **policy)
