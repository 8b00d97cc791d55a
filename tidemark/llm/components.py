"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.workspace import discard, materialise


def _both(first: tuple[str, str], second: tuple[str, str], names: tuple[str, str]) -> Column:
    """Two rows of each, in one pass."""
    return F.explode(F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(pair, names, strict=True)]) for pair in (first, second)])).alias("x")


def _stars(edges: DataFrame, *, larger: bool) -> DataFrame:
    """Each node hangs its neighbours (the greater ones, or the lesser ones and itself) on its least. May repeat edges."""
    if larger:
        around = edges.select(_both(("a", "b"), ("b", "a"), ("u", "v"))).select("x.*")
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = around.join(least, "u")
    if larger:
        new = hung.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        new = hung.select(_both(("v", "m"), ("u", "m"), ("a", "b"))).select("x.*")
    return new.filter("a <> b")


def _flat(edges: DataFrame) -> bool:
    """Whether each node has one lesser neighbour at most and such a neighbour has none: all edges, from a to the
    lesser b, join a node to its component's least."""
    ends = edges.withColumns({"up": F.lit(1), "top": F.lit(0)}).select(_both(("a", "up"), ("b", "top"), ("node", "up")))
    nodes = ends.groupBy("x.node").agg(F.sum("x.up").alias("ups"), F.min("x.up").alias("top"))
    most = nodes.agg(F.max(F.col("ups") + 1 - F.col("top"))).first()[0]  # of a lesser neighbour that has none: 1
    return most is None or most <= 1


def components(links: DataFrame) -> DataFrame:
    """links: a, b; ends that are null are no nodes. Gives `node` and `label`, its component's least node, for all other nodes with a link.

    Both steps keep components as they are and shorten paths, until every edge joins a node to its
    component's least. A node's neighbours are only ever grouped by a partial minimum.
    """
    edges = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _flat(edges):
        before, edges = edges, materialise(_stars(_stars(edges, larger=True), larger=False).distinct(), "edges")
        discard(before)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`components` of a graph that some links were added to, from its former ones: only links between
    different components are looked at, as links of the components' least nodes."""
    ends = links.select("a", "b")
    for end in ("a", "b"):
        ends = ends.join(labels.select(F.col("node").alias(end), F.col("label").alias("of")), end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
    found = components(ends)
    moved = labels.join(found.select(F.col("node").alias("label"), F.col("label").alias("least")), "label", "left")
    # The new components' nodes are former least nodes, or had no link: none of them is among the former nodes.
    after = materialise(moved.select("node", F.coalesce("least", "label").alias("label")).unionByName(found), "labels")
    discard(found)
    return after
