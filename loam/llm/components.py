"""Connected components of a link table, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour greater than a node is linked to the node's least neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and itself, are linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _unfinished(links: DataFrame) -> bool:
    """Whether some node has a link to a smaller one and another link besides: then not every link points at a root."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"))
    )
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("links"))
    return seen.agg(F.max(F.expr("up > 0 and links > 1"))).first()[0] or False


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``) other than its component's least node.

    The links are rewritten until each points at the least node of its
    component; rounds grow with the logarithm of the component's size.  Each
    round is two aggregates and two equi-joins over the links, written to the
    shared folder; only whether another is needed comes to the driver.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    links = stage(links.distinct(), name)
    while _unfinished(links):
        links = stage(_small_star(_large_star(links)), name)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def with_links(roots: DataFrame, links: DataFrame, name: str = "links") -> DataFrame:
    """:func:`components` of the links behind ``roots`` (its result) and of further ``links`` together.

    Whole components are the nodes here, so the rounds run over the further
    links only.
    """
    root_of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    between = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
    tops = components(between.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")), name)
    lifted = roots.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return stage(lifted.select("node", F.coalesce("top", "root").alias("root")).unionByName(tops), name)
