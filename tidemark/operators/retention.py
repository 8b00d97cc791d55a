"""Retention: which backup sets have outlived a keep-N or older-than-D-days policy.

Input is one row per manifest with its family columns, `set_token`, `set_ts` and name. Rows whose
name carries no token take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.options import parse_count
from tidemark.functions.stamps import cutoff_stamp
from tidemark.workspace import materialise

FAMILY = ("destination", "database", "driver", "mode")
DAY_LENGTH = 8


def _same_family(family: Sequence[str], left: str, right: str) -> Column:
    condition = F.lit(True)
    for name in family:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def _reach(counts: DataFrame, carried: Sequence[str], level: str) -> DataFrame:
    """Of each group of counts the row of `level`, newest first, in which the needed one lies, and which
    one of its own it is."""
    newer = F.sum("n").over(Window.partitionBy(*carried).orderBy(F.desc(level))) - F.col("n")
    found = counts.withColumn("newer", newer).filter((F.col("newer") < F.col("need")) & (F.col("need") <= F.col("newer") + F.col("n")))
    return found.withColumn("need", F.col("need") - F.col("newer")).drop("newer")


def _cut_by_counts(sets: DataFrame, family: Sequence[str], keep: int) -> DataFrame:
    """The keep-th newest set of every family by counting: first its day, then its second, then its name.

    One pass over the sets counts each second, with its first and last name; days are summed from that.
    Only counts are ordered in a window: as many rows per family as there are days, then seconds of one
    day. Names are looked up only where the cut lies between the first and the last of its second.
    """
    named = sets.filter(F.col("set_ts").isNotNull())
    seconds = named.groupBy(*family, "set_ts").agg(
        F.count(F.lit(1)).alias("n"), F.min("manifest").alias("first"), F.max("manifest").alias("last")
    )
    seconds = materialise(seconds.withColumn("day", F.substring("set_ts", 1, DAY_LENGTH)), "retention-seconds")
    days = seconds.groupBy(*family, "day").agg(F.sum("n").alias("n")).withColumn("need", F.lit(keep).cast("bigint"))
    day = _reach(days, family, "day").select(*family, "day", "need")
    within = seconds.alias("s").join(day.alias("c"), _same_family([*family, "day"], "s", "c")).select("s.*", "c.need")
    cut = materialise(_reach(within, family, "set_ts"), "retention-cut")
    name = F.when(F.col("need") == 1, F.col("last")).when(F.col("need") == F.col("n"), F.col("first"))
    cut = cut.withColumn("manifest", name)
    between = cut.filter("manifest IS NULL")
    if between.isEmpty():
        return cut.select(*family, "set_ts", "manifest")
    names = named.alias("s").join(between.alias("c"), _same_family([*family, "set_ts"], "s", "c")).select("s.*", "c.need")
    place = F.row_number().over(Window.partitionBy(*family).orderBy(F.desc("manifest")))
    looked_up = names.withColumn("place", place).filter(F.col("place") == F.col("need"))
    return cut.filter("manifest IS NOT NULL").select(*family, "set_ts", "manifest").unionByName(looked_up.select(*family, "set_ts", "manifest"))


def flag_expired(
    manifests: DataFrame,
    *,
    keep: int | str | None = None,
    days: int | str | None = None,
    as_of: datetime | str | None = None,
    family: Sequence[str] = FAMILY,
) -> DataFrame:
    """The manifests with `by_keep`, `by_age` and `expired`, their union.

    The two rules are one predicate on each row, so nothing is unioned or made distinct. Only the
    cut of each family is computed; it is stored, and joined by its measured size. A row without
    a token sorts behind all others in its family and is neither old nor surplus.
    """
    days = parse_count(days, "days")
    if not isinstance(keep, int) or isinstance(keep, bool):
        keep = parse_count(keep, "keep")
    if days is not None and as_of is None:
        raise ValueError("days needs as_of, the instant that ages are counted from")
    by_age = F.lit(False)
    if days is not None:
        by_age = F.coalesce(F.col("set_ts") < cutoff_stamp(as_of, days), F.lit(False))
    if keep is None or keep < 0:
        flagged = manifests.withColumn("by_keep", F.lit(False))
    elif keep == 0:
        flagged = manifests.withColumn("by_keep", F.col("set_token").isNotNull())
    else:
        manifests = materialise(manifests, "retention")  # what they are made from is read once
        cut = materialise(_cut_by_counts(manifests.select(*family, "set_ts", "manifest"), family, keep), "retention-cut")
        # Structs order NULL first instead of comparing to NULL, hence the separate test.
        older = F.struct("s.set_ts", "s.manifest") < F.struct("c.set_ts", "c.manifest")
        older = F.col("s.set_ts").isNotNull() & older
        flagged = (
            manifests.alias("s")
            .join(cut.alias("c"), _same_family(family, "s", "c"), "left")
            .select("s.*", F.coalesce(older, F.lit(False)).alias("by_keep"))
        )
    return flagged.withColumn("by_age", by_age).withColumn(
        "expired", F.col("by_keep") | F.col("by_age")
    )


def expired_sets(manifests: DataFrame, **policy) -> DataFrame:
    """The manifests that the policy expires, with all their columns."""
    flagged = flag_expired(manifests, **policy).filter("expired")
    return flagged.select(*manifests.columns)


def expired_tokens(expired: DataFrame, family: Sequence[str] = FAMILY) -> DataFrame:
    return expired.select(*family, "set_token").distinct()


def expired_artifacts(
    expired: DataFrame, artifacts: DataFrame, family: Sequence[str] = FAMILY
) -> DataFrame:
    """Artifacts of expired sets, by exact equality on the family and the token.

    The tokens are stored first and joined by their measured size.
    """
    tokens = materialise(expired_tokens(expired, family), "expired-tokens")
    return artifacts.join(tokens, [*family, "set_token"], "left_semi").select(*artifacts.columns)


def expired_counts(expired: DataFrame) -> DataFrame:
    """Expired sets per destination."""
    return expired.groupBy("destination").agg(
        F.count_distinct("database", "driver", "mode", "set_token").alias("n_sets")
    )


def family_counts(manifests: DataFrame, keep: int, family: Sequence[str] = FAMILY) -> DataFrame:
    """Sets per family and how many of them exceed `keep`."""
    parsed = manifests.filter(F.col("set_token").isNotNull())
    return (
        parsed.groupBy(*family)
        .agg(F.count(F.lit(1)).alias("n_sets"))
        .withColumn("excess", F.greatest(F.lit(0).cast("bigint"), F.col("n_sets") - keep))
    )
