"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the links ``(a, b)`` (longs, either order) with the
    least node of its component. Links are pulled to the least neighbour until
    nothing moves, a number of rounds that grows with the logarithm of the
    longest chain. Every round is a written table; the driver sees two numbers."""
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = write_table(both, "links")
    state = _state(links)
    while state[0]:
        # large star: every greater neighbour of a node moves to the node's least neighbour
        sym = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sym.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = sym.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        small = (moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        links = write_table(small, "links")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
