"""Connected components of a graph given as edges, by hooking and contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the smallest node of its component.

    Each round hooks every root to its smallest neighbour, follows the hooks to their ends, and keeps
    the distinct edges between the roots that remain; every root but the smallest of its surroundings
    goes, so rounds grow with the logarithm of the longest chain. Minima are taken in each task before
    a shuffle; the joins have one row per key on one side, so a hub's rows may be split. Null ends
    and loops are ignored. No part of the graph passes through the driver but one count a round.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    both = edges.filter(F.col(left) != F.col(right))
    rest = both.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).distinct().checkpoint()
    ends = rest.select(F.col("a").alias("node")).union(rest.select(F.col("b").alias("node"))).distinct()
    roots = ends.withColumn("root", F.col("node")).checkpoint()
    while not rest.isEmpty():
        hooks = rest.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("up")).checkpoint()
        while True:
            further = hooks.select(F.col("root").alias("up"), F.col("up").alias("top"))
            hooks = hooks.join(further, "up", "left").select("root", F.coalesce("top", "up").alias("up"), "top").checkpoint()
            moved = not hooks.filter("top IS NOT NULL").isEmpty()
            hooks = hooks.drop("top")
            if not moved:
                break
        roots = roots.join(hooks, "root", "left").select("node", F.coalesce("up", "root").alias("root")).checkpoint()
        for end in ("a", "b"):
            rest = rest.join(hooks.withColumnRenamed("root", end), end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
        rest = rest.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
        rest = rest.distinct().checkpoint()
    return roots
