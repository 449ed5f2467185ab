"""The reference's collective demo jobs as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.combiners import Combiner, int_div, plus
from corvid.operators import graph, keyed


def graph_degrees(edge_list: DataFrame) -> DataFrame:
    """Edges regrouped by target give the vertex table (+1 per incoming edge = G28),
    edges by source give the message table (+1 per outgoing edge = G29), and the messages
    are joined to the vertex table by id (J1, unmatched kept):
    ``(vertex, in_degree, out_degree)``, either side null where the vertex has none."""
    vertices = graph.in_degree(edge_list).withColumnRenamed("dst", "vertex")
    messages = graph.out_messages(edge_list).withColumnRenamed("src", "vertex")
    return keyed.join_to_static(messages, vertices, "vertex", plus("out_degree"), keep_unmatched=True)


def word_average(rows: DataFrame, word: str = "word", val: str = "val", cnt: str = "cnt",
                 n: int | None = None) -> DataFrame:
    """I8: (sum, count) per word combined across workers (G10 + G13), then the finish
    function ``sum / count`` in integer division (G11)."""
    combined = keyed.regroup(rows.select(word, val, cnt), word, plus(val, cnt), n)
    return combined.select(word, F.col(val).alias("total"), F.col(cnt).alias("count"),
                           int_div(val, cnt).alias("average"))


def push_pull_sync(local: DataFrame, global_: DataFrame, key: str, combiner: Combiner,
                   on_missing: str = "error") -> tuple[DataFrame, DataFrame]:
    """Push local rows into the global table (J2), then pull the new global rows back
    into every local table (J3, which adds). Returns ``(new_global, new_local)``."""
    new_global = keyed.push(local, global_, key, combiner)
    new_local = keyed.pull(local, new_global, key, combiner, on_missing=on_missing)
    return new_global, new_local
