"""Mixing sources to target weights: hierarchical budgeting over a tree of domain, language and source.

The token budget flows down the tree. At each node it is shared among the children by weight; a child
that has fewer tokens than its share (its documents, each usable `max_epochs` times) gives what it lacks
to its siblings, by weight again, and only what no sibling can use goes back to the parent's siblings.
Since a node's capacity is that of all its leaves, one pass down the tree does both. All sums are whole
numbers. A leaf's documents stand in an order seeded anew for each epoch; it takes whole epochs while its
budget lasts, and of the next one the prefix that still fits.

The prefix of a leaf is found without gathering the leaf: documents are counted by the first digits of
their place in the order, then, in the one bucket where the budget ends, by the next digits, and only
the last bucket's rows are summed one by one.

Defined results: null domain, language or source are values of their own; a null or empty text has no
tokens and goes with the document before it; rows of one leaf with the same doc_id share one fate; a leaf
without tokens takes every document once if its budget is 0 of 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.words import words
from tidemark.workspace import materialise

TREE = ("domain", "lang", "source")
DIGITS = 3  # hexadecimal, of the order's hash, in each of two steps


def _weight(level: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(F.col(level) == name, w).otherwise(out)
    return out.cast("decimal(18,0)")


def _share(nodes: DataFrame, parent: list[str], level: str, weights: dict[str, int]) -> DataFrame:
    """nodes: `parent`, the parent's `budget`, a child `level` and its `capacity`. Gives each child's budget.

    In order of capacity for weight, children are full up to some place, and those after share the rest.
    """
    rows = nodes.withColumn("w", _weight(level, weights))
    order = [F.col("capacity").cast("double") / F.col("w").cast("double"), F.col(level).asc_nulls_first()]
    at = Window.partitionBy(*parent).orderBy(*order)
    before = at.rowsBetween(Window.unboundedPreceding, -1)
    onward = at.rowsBetween(0, Window.unboundedFollowing)
    number = "decimal(38,0)"
    rows = rows.withColumn(
        "left_tokens", (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))).cast(number)
    ).withColumn("left_w", F.sum("w").over(onward))
    rows = rows.withColumn(
        "full", (F.col("capacity") * F.col("left_w")).cast(number) <= (F.col("w") * F.col("left_tokens")).cast(number)
    )
    whole = Window.partitionBy(*parent)
    rest = (F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole), F.lit(0)))
    rows = rows.withColumn("rest", rest.cast(number)).withColumn(
        "rest_w", F.sum(F.when(~F.col("full"), F.col("w"))).over(whole).cast(number)
    ).withColumn("part", (F.col("w") * F.col("rest")).cast(number))
    share = F.when(F.col("full"), F.col("capacity").cast("long")).otherwise(F.expr("part div rest_w"))
    return rows.select(*parent, level, share.cast("decimal(18,0)").alias("budget"))


def _same(left: str, right: str, on) -> Column:
    out = F.lit(True)
    for c in on:
        out &= F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def leaf_budgets(
    leaves: DataFrame, *, budget_percent: int, max_epochs: int, weights: dict[str, dict[str, int]]
) -> DataFrame:
    """leaves: the tree's columns and `tokens`. Adds `budget`, in tokens."""
    sized = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast("decimal(18,0)"))
    total = sized.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    parents = None
    for depth, level in enumerate(TREE):
        above, path = list(TREE[:depth]), list(TREE[: depth + 1])
        nodes = sized.groupBy(*path).agg(F.sum("capacity").cast("decimal(18,0)").alias("capacity"))
        if parents is None:
            nodes = nodes.withColumn("budget", F.lit(int(total) * budget_percent // 100).cast("decimal(18,0)"))
        else:
            nodes = nodes.alias("n").join(parents.alias("p"), _same("n", "p", above)).select("n.*", "p.budget")
        parents = _share(nodes, above, level, weights.get(level, {}))
    return sized.alias("n").join(parents.alias("p"), _same("n", "p", TREE)).select("n.*", "p.budget").drop("capacity")


def choose(
    docs: DataFrame,
    *,
    domain: Column,
    budget_percent: int = 50,
    max_epochs: int = 2,
    seed: int = 17,
    weights: dict[str, dict[str, int]] | None = None,
) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens and `copies`, 1 or more, of the documents that are used."""
    narrow = materialise(
        docs.select(
            "doc_id", domain.cast("string").alias("domain"), F.col("lang").cast("string").alias("lang"),
            F.col("source").cast("string").alias("source"),
            F.size(words(F.col("text"))).cast("long").alias("n_tokens"),
        ),
        "mix",
    )
    leaves = narrow.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, budget_percent=budget_percent, max_epochs=max_epochs, weights=weights or {})
    whole = F.when(F.col("tokens") > 0, F.expr("cast(budget as bigint) div tokens")).otherwise(1)
    budgets = budgets.withColumn("whole", whole).withColumn(
        "rest", F.when(F.col("tokens") > 0, F.col("budget").cast("long") - F.col("whole") * F.col("tokens")).otherwise(0)
    )
    budgets = materialise(budgets.select(*TREE, "whole", "rest"), "budgets")
    place = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed = (
        narrow.alias("n").join(budgets.alias("b"), _same("n", "b", TREE)).select("n.*", "b.whole", "b.rest")
        .withColumn("place", place)
    )
    first = F.substring("place", 1, DIGITS)
    second = F.substring("place", 1 + DIGITS, DIGITS)
    ends = _end(placed.groupBy(*TREE, first.alias("bucket")).agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest")))
    ends = materialise(ends, "ends")
    inner = (
        placed.alias("n").join(ends.alias("e"), _same("n", "e", TREE) & (first == F.col("e.bucket")))
        .select("n.*", F.col("e.left").alias("left"))
    )
    ends2 = materialise(
        _end(inner.groupBy(*TREE, second.alias("bucket")).agg(F.sum("n_tokens").alias("n"), F.first("left").alias("rest"))),
        "ends",
    )
    rows = (
        inner.alias("n").join(ends2.alias("e"), _same("n", "e", TREE) & (second == F.col("e.bucket")))
        .select(*[f"n.{c}" for c in (*TREE, "place", "n_tokens")], F.col("e.left").alias("left"))
    )
    # Rows of one doc_id have one place: they are summed up first, however many there are.
    rows = rows.groupBy(*TREE, "place").agg(F.sum("n_tokens").alias("n_tokens"), F.first("left").alias("left"))
    rows = rows.withColumn("sum", F.sum("n_tokens").over(Window.partitionBy(*TREE).orderBy("place")))
    last = (
        rows.groupBy(*TREE)
        .agg(F.max(F.when(F.col("sum") <= F.col("left"), F.col("place"))).alias("last"), F.min("place").alias("least"))
    )
    # Everything before the last bucket fits; in it, everything up to the last place that fits.
    edge = (
        ends.alias("n").join(ends2.alias("e"), _same("n", "e", TREE), "left").join(last.alias("l"), _same("n", "l", TREE), "left")
        .select(*[f"n.{c}" for c in TREE], F.coalesce("l.last", F.concat("n.bucket", "e.bucket")).alias("edge"), F.col("l.last").alias("last"))
    )
    edge = materialise(edge, "edge")
    taken = placed.alias("n").join(edge.alias("e"), _same("n", "e", TREE), "left")
    in_prefix = F.when(F.col("e.edge").isNull(), F.lit(True)).when(
        F.col("e.last").isNull(), F.col("n.place") < F.col("e.edge")
    ).otherwise(F.col("n.place") <= F.col("e.edge"))
    copies = F.col("n.whole") + F.when((F.col("n.rest") > 0) & in_prefix, 1).otherwise(0)
    out = taken.select(*[f"n.{c}" for c in ("doc_id", *TREE, "n_tokens")], copies.cast("long").alias("copies"))
    return out.filter(F.col("copies") > 0)


def _end(buckets: DataFrame) -> DataFrame:
    """The bucket of each leaf in which its `rest` ends, and what is `left` of it there."""
    at = Window.partitionBy(*TREE).orderBy("bucket")
    summed = buckets.withColumn("upto", F.sum("n").over(at))
    over = summed.filter(F.col("upto") > F.col("rest"))
    return over.groupBy(*TREE).agg(F.min(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("n")).alias("left"))).alias("e")).select(
        *TREE, "e.bucket", "e.left"
    )


def mix(docs: DataFrame, *, domain: Column, **options) -> DataFrame:
    """The documents used, with all columns they came with, each row as often as its `copies` say."""
    chosen = choose(docs, domain=domain, **options).select("doc_id", *TREE, "copies").distinct()
    chosen = chosen.select(*[F.col(c).alias(f"__{c}") for c in ("doc_id", *TREE, "copies")])
    keys = {"doc_id": F.col("doc_id"), "domain": domain.cast("string"), "lang": F.col("lang").cast("string"), "source": F.col("source").cast("string")}
    same = F.lit(True)
    for name, key in keys.items():
        same &= key.eqNullSafe(F.col(f"__{name}"))
    joined = docs.join(chosen, same)
    again = joined.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return again.select(*docs.columns)
