"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinshelf.llm.common import stored


def _star(edges: DataFrame, pairs: DataFrame, *, large: bool) -> DataFrame:
    """Link neighbours of each node ``u`` to the least node among them and ``u``.

    Only the minimum of a neighbourhood is gathered (before the shuffle, too); neighbours
    are never brought together, so a node with very many is no large group.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = pairs.join(least, "u")
    moved = linked.filter("v > u" if large else "true").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (a, b); root is the least node.

    Nodes are of any type with an order. Each round is written to the shared folder;
    rounds grow with the logarithm of a component's width. Self links and repeated links
    are allowed; an empty table gives an empty result.
    """
    current = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        grown = _star(current, both, large=True)
        down = grown.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        current = stored(_star(grown, down, large=False), "edges")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    # every remaining link is (node, root)
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
