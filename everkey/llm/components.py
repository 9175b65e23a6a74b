"""Connected components by alternating large-star and small-star steps.

Each step replaces links by links to the smallest neighbour and keeps components as they are; after a few rounds every
node hangs on the smallest of its component.  Every step is written to the shared folder, so lost executors cost no more
than the step at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.joins import grouped
from ..session import written


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """One row for each link; repeats are dropped by the small-star step that follows."""
    both = links.select("a", "b").union(links.select("b", "a"))
    least = grouped(both, ["a"], F.min("b").alias("m"))
    hung = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    return hung.where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = grouped(down, ["a"], F.min("b").alias("m"))
    # The link to the smallest neighbour stays, and hangs the node itself on it; each other one hangs that neighbour.
    hung = down.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return hung.distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links`` (columns a, b) but the roots: the smallest node of its component.

    Links may repeat, point either way or to themselves; null ends are left out; no links give no rows.
    """
    at = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _signature(at)
    while True:
        large = written(_large_star(at), "large-star")
        # If no link moved, every link ends at a root; if no node has two, all hang where they belong.
        if _signature(large) == before and at.groupBy("a").count().where("count > 1").isEmpty():
            return at.select(F.col("a").alias("node"), F.col("b").alias("root"))
        at = written(_small_star(large), "small-star")
        before = _signature(at)
