"""Link-graph operators.

A graph is an adjacency DataFrame ``(src int, dst array<int>)`` as read by
:func:`corvid.sources.text.read_adjacency`, or a flat edge list ``(src, dst)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges(adj: DataFrame) -> DataFrame:
    """Flatten adjacency to ``(src, dst)``; repeated targets stay repeated."""
    return adj.select("src", F.explode("dst").alias("dst"))


def out_degree(adj: DataFrame, duplicates: str = "bag") -> DataFrame:
    """Out-degree per node. ``bag`` counts repeated targets (list size, used as the
    divisor by both reference programs); ``set`` counts distinct targets."""
    size = F.size("dst") if duplicates == "bag" else F.size(F.array_distinct("dst"))
    return adj.select("src", size.cast("long").alias("out_degree"))


def out_degree_edges(edge_list: DataFrame) -> DataFrame:
    """P2 on a flat edge list: ``bag`` counts every link, ``set`` distinct targets."""
    return edge_list.groupBy("src").agg(F.count(F.lit(1)).alias("bag"), F.countDistinct("dst").alias("set"))


def dangling_pages(edge_list: DataFrame, n_pages: int) -> DataFrame:
    """P3 (which pages): pages 0..n_pages-1 without an out-link (anti join)."""
    pages = edge_list.sparkSession.range(n_pages).select(F.col("id").alias("page"))
    return pages.join(edge_list.select(F.col("src").cast("bigint").alias("page")).distinct(), "page", "left_anti")


def in_degree(edge_list: DataFrame) -> DataFrame:
    """One increment per incoming edge, i.e. the in-degree (partial counts are
    combined map-side before the shuffle, so a hot target costs one row per task)."""
    return edge_list.groupBy("dst").agg(F.count(F.lit(1)).alias("in_degree"))


def out_messages(edge_list: DataFrame) -> DataFrame:
    """One increment per outgoing edge of each source."""
    return edge_list.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def max_node(adj: DataFrame) -> DataFrame:
    """Largest node id and the implied node count (max id + 1)."""
    return adj.agg(F.max("src").alias("max_id"), (F.max("src") + 1).alias("n_nodes"))


def dangling(adj: DataFrame) -> DataFrame:
    """P3 (which nodes): nodes without out-links. Their mass is spread by a closed form
    in the PageRank plan, never by materialising the N*N links they imply."""
    return adj.filter(F.size("dst") == 0).select("src")


def top_ranks(ranks: DataFrame, k: int = 10) -> DataFrame:
    """The k highest ranks, descending; equal ranks by ascending page."""
    return ranks.orderBy(F.desc("rank"), F.asc("page")).limit(k)


def ordered_ranks(ranks: DataFrame) -> DataFrame:
    """Pages ascending (the written output order)."""
    return ranks.orderBy("page")
