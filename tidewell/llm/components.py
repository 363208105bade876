"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import stored

MAX_ROUNDS = 60


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's larger (or other) neighbours are joined to the smallest node next to it. Minima
    are partly taken before the shuffle, so a hub costs one row for each task there. In the join a hub's
    edges, two ids each, share a key with a single row on the other side; beyond Spark's limits for skewed
    partitions (adaptive.skewJoin, on unless a session turns it off) they are split over tasks."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not larger:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    moved = both.join(least, F.col("u") == F.col("w"))
    if larger:
        out = moved.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = moved.select(F.col("m").alias("a"), F.col("v").alias("b")).union(least.select(F.col("m").alias("a"), F.col("w").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) but the roots themselves; a root is the
    smallest node of its component. The rounds grow with the logarithm of the longest path."""
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        now = stored(_star(_star(now, True), False))
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
