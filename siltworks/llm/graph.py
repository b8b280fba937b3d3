"""Connected components of an edge table, by alternating large and small stars.

Every round is two joins and two aggregations over the edges; the count of
rounds grows with the logarithm of the longest chain.  Only two numbers per
round reach the driver.  Where there are many edges, a node's least neighbour is
written before it is joined back: both sides of the join are then plain
shuffles, of which Spark can split a hub's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import cut, discard

#: Edges from which on a node's least neighbour is written before it is joined back.
_MANY = 1_000_000


def _large_star(edges: DataFrame, own: Callable[[DataFrame], DataFrame]) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = own(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, own: Callable[[DataFrame], DataFrame]) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = own(down.groupBy("a").agg(F.min("b").alias("m")))
    side = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return side.union(least)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs to ``(node, root)``; root is the least node reachable.

    Nodes without an edge to another node are not in the result, nor are rows
    with a null end.  Repeated edges and self-loops do no harm.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while True:
        used = [now]

        def own(least: DataFrame, many: bool = state[0] > _MANY, used: list[DataFrame] = used) -> DataFrame:
            if many:
                used.append(cut(least, "least"))
                return used[-1]
            return least

        large = _large_star(now, own).distinct()
        if state[0] > _MANY:
            large = cut(large, "edges")
            used.append(large)
        stars = cut(_small_star(large, own).distinct(), "edges")
        after = _state(stars)
        for x in used:
            discard(x)
        now = stars
        if after == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = after
