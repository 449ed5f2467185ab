"""Connected components of an edge list by alternating large-star and small-star rounds.

Every round is two aggregates and two joins on the node; only a count and a checksum of
the edges reach the driver. A hub's edges are combined before the exchange (``min``). The
minima are written out before they are joined back: both join sides are then plain
exchanges, so adaptive execution can split a hub's edges over tasks. Lineage is cut by
``checkpoint()`` into the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.session import cut_lineage


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return int(r["n"]), int(r["s"] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")))
    return (both.join(low, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = cut_lineage(down.groupBy("a").agg(F.min("b").alias("m")))
    moved = down.join(low, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).filter(F.col("a") != F.col("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``(a, b)`` edges to ``(a, b)``: every node but the smallest of its component, with
    that smallest node. An empty edge list gives an empty result."""
    now = cut_lineage(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct())
    state = _state(now)
    while state[0]:
        now = cut_lineage(_small_star(_large_star(now)))
        state, last = _state(now), state
        if state == last:
            break
    return now
