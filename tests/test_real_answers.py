"""The catalogue's answers say something, and behaviour that its queries can't show."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF
from corvid.functions.combiners import grouped_udf, plus, together
from corvid.operators import forest as fo
from corvid.operators import keyed
from corvid.plans import catalog
from corvid.plans.forest import load_forest, predict, save_forest, train_forest
from corvid.plans.pagerank import pagerank, prepare_edges
from corvid.sources.text import parse_adjacency

DIR = f"{SF}/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="driver tables not present")


@needs_tables
def test_forest_is_a_forest(spark):
    nodes = catalog.q_forest_nodes(spark, DIR).collect()
    trees = {}
    for r in nodes:
        trees.setdefault(r.tree, set()).add((r.node, r.feature))
    assert len(trees) == catalog.FOREST_TREES and len({frozenset(t) for t in trees.values()}) > 1
    assert max(r.node for r in nodes) >= 8 and {r.prediction for r in nodes} >= {0, 1}
    acc = catalog.q_accuracy(spark, DIR).first()
    assert acc.tn > 0 and acc.tp > 0 and acc.total < spark.read.parquet(f"{DIR}/documents.parquet").count()
    assert {r.prediction for r in catalog.q_forest_predict(spark, DIR).collect()} == {0, 1}


@needs_tables
def test_keyed_answers_have_matched_and_unmatched_rows(spark):
    users = {r.key for r in catalog._user_events(spark, DIR).distinct().collect()}
    customers = {r.key for r in catalog._cust_global(spark, DIR).collect()}
    assert users & customers and users - customers and customers - users
    j = catalog.q_join_to_static(spark, DIR)
    assert j.filter("c_nationkey is null").count() and j.filter("total is null").count() and j.filter(
        "total is not null and c_nationkey is not null").count()
    assert 0 < catalog.q_remove_val(spark, DIR).count() < len(customers)
    g = catalog.q_get_val(spark, DIR)
    assert g.filter("val = 0").count() and g.filter("val > 0").count()
    assert {r.majority for r in catalog.q_majority_toxic(spark, DIR).collect()} == {0}


def _pair(spark):
    local = spark.createDataFrame([(1, 10), (1, 5), (2, 7)], "key int, val bigint")
    return local, spark.createDataFrame([(1, 100), (3, 300)], "key int, val bigint")


def test_pull_combiners_and_missing_ids(spark):
    def longest(v: pd.Series) -> int:
        return int(v.max())

    local, glob = _pair(spark)
    got = {(r.key, r.val) for r in keyed.pull(local, glob, "key", plus("val"), on_missing="keep").collect()}
    assert got == {(1, 115), (2, 7)}
    none = keyed.pull(local, glob, "key", None, on_missing="keep")
    assert none.columns == ["key", "val"] and none.count() == 3
    best = keyed.pull(local, glob, "key", grouped_udf(longest, "val", "bigint"), on_missing="keep")
    assert {(r.key, r.val) for r in best.collect()} == {(1, 100), (2, 7)}
    for use in (lambda d: d.count(), lambda d: d.select("key").collect(), lambda d: d.collect()):
        with pytest.raises(Exception, match="missing from the global table"):
            use(keyed.pull(local, glob, "key", plus("val")))
    assert keyed.pull(local.filter("key = 1"), glob, "key", plus("val")).count() == 1
    with pytest.raises(ValueError):
        together(plus("a"), grouped_udf(longest, "b", "bigint"))


def test_get_val_keeps_a_null_that_is_held(spark):
    table = spark.createDataFrame([(1, None), (2, 5)], "key int, val int")
    keys = spark.createDataFrame([(1,), (2,), (3,)], "key int")
    assert {(r.key, r.val) for r in keyed.get_val(table, keys, "key", {"val": 0}).collect()} == {(1, None), (2, 5), (3, 0)}


def test_broadcast_bound_counts_the_columns(spark):
    df = spark.range(10).select(F.col("id").alias("key"), F.col("id").cast("double").alias("v"))
    assert keyed.row_bound(df) == 64 + 16
    assert keyed.row_bound(df.withColumn("a", F.array("v"))) is None


def test_pagerank_never_stops_early_in_silence(spark):
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 1)], "src int, dst int")
    with pytest.raises(RuntimeError, match="no convergence"):
        pagerank(prepare_edges(edges, 3), delta=1e-12, max_rounds=4)
    assert pagerank(prepare_edges(edges, 3), delta=1e-6).max_change <= 1e-6


def test_graph_ids_beyond_32_bits(spark):
    from corvid.operators import graph

    big = 1 << 33
    edges = spark.createDataFrame([(big, big + 1), (big, big + 2)], "src bigint, dst bigint")
    assert graph.out_messages(edges).first().src == big
    assert graph.in_degree(edges).count() == 2
    assert graph.max_node(edges).first().n_nodes == big + 1


def test_adjacency_lines_with_tabs(spark):
    lines = spark.createDataFrame([(0, "\t3 1\t2 "), (1, "4"), (2, "3 9 x 7")], "line_no int, value string")
    assert {(r.src, tuple(r.dst)) for r in parse_adjacency(lines).collect()} == {(3, (9,)), (4, ())}
    with pytest.raises(Exception, match="without a node id"):
        parse_adjacency(spark.createDataFrame([(0, " \t")], "line_no int, value string")).collect()


def test_entropy_of_a_pure_side_is_zero(spark):
    p = spark.createDataFrame([(0.0,), (1.0,), (0.5,), (1.5,)], "p double").select(fo.entropy(F.col("p")).alias("e"))
    got = [r.e for r in p.collect()]
    assert got[:2] == [0.0, 0.0] and abs(got[2] - 0.6931471805599453) < 1e-12 and got[3] is None
    labels = spark.createDataFrame([(i, int(i < 3)) for i in range(6)], "example int, label int")
    posts = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2), ("b", 4)], "feature string, example int")
    nodes = train_forest(labels, posts, num_trees=1, max_depth=2, subset=None, impurity="entropy", duplicates="set").nodes
    root = nodes.filter("node = 1").first()
    assert (root.feature, root.is_leaf) == ("a", False)


def test_saved_forest_keeps_its_facts(spark, tmp_path):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(12)], "example int, label int")
    posts = spark.createDataFrame([(f"f{i % 4}", i) for i in range(12)] + [("g", 0), ("g", 3), ("g", 1)], "feature string, example int")
    model = train_forest(labels, posts, num_trees=3, max_depth=3, subset=None)
    save_forest(model, str(tmp_path / "m"))
    back = load_forest(spark, str(tmp_path / "m"))
    assert (back.num_trees, back.max_depth, back.identical) == (3, 3, True)
    key = lambda m: {(r.example, r.prediction) for r in predict(m, labels, posts).collect()}
    assert key(back) == key(model)


def test_link_rule_graph_ranks_against_a_loop(spark):
    """The 1000-page graph of the link rule, MPI rules, against a plain loop."""
    from corvid.plans.pagerank import prepare_adjacency
    from corvid.sources.generate import generate_links

    n = 200
    adj = generate_links(spark, n, 26)
    lists = {r.src: list(r.dst) for r in adj.collect()}
    rank = [1 / n] * n
    for _ in range(6):
        new = [0.15 / n] * n
        for i in range(n):
            out = lists.get(i) or [j for j in range(n) if j != i]
            for j in out:
                new[j] += 0.85 * rank[i] / len(out)
        rank = new
    got = pagerank(prepare_adjacency(adj, "mpi"), delta=-1, max_rounds=6).ranks.collect()
    assert len(got) == n and max(abs(r.rank - rank[r.page]) for r in got) < 1e-12
