"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import Steps


def _stars(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Hang neighbours on the least node they can see: the larger ones, or the smaller ones."""
    if both_ways:
        sides = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = sides.join(least, "a")
    if both_ways:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """``(node, root)`` for each node of the edges ``(a, b)``: root is the least node reachable.

    Each round is two groupings and joins over the edges; a hub is a sum per task and
    a join that adaptive execution splits. Rounds are written, so none is done twice, and
    removed when the next is. Components found before may stand in for their edges. An edge
    table without rows has no components; ``limit`` only guards against a fault.
    """
    steps = Steps(edges.sparkSession)
    now = steps.written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .where("a <> b").distinct(), "stars")
    marked = None
    for _ in range(limit):
        before, now = now, steps.written(_stars(_stars(now, True), False), "stars")
        steps.remove(before)
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == marked:
            break
        marked = mark
    else:
        raise RuntimeError("the components did not settle")
    tree = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return tree.unionAll(tree.select(F.col("root").alias("node"), "root").distinct())
