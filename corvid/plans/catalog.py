"""Query catalog over the driver tables: every operator of the inventory run on Spark,
next to an equivalent SQL text for an independent engine (the correctness oracle).

Conventions shared by both sides: doubles are rounded (``round(x, k)``, ``k`` chosen so
float summation order cannot change the result), counts are ``bigint``, every computed
column is aliased to the same name. The link graph used by the graph queries is
supplier -> part from ``lineitem``: node ``s_suppkey`` for a supplier and
``S + p_partkey`` for a part, with ``S = max(s_suppkey) + 1`` and
``N = S + max(p_partkey) + 1``; parts have no out-links, so they are dangling.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.functions.combiners import array_plus, concat_lists, grouped_udf, lists_by_key, plus, sum_wide_arrays, together
from corvid.operators import forest as fo
from corvid.operators import graph, keyed, stored, tasks
from corvid.plans import collectives, kmeans, pagerank
from corvid.plans.forest import number_features, predict, train_forest, tree_bytes, trees_from_bytes
from corvid.plans.inplace import pagerank_in_place
from corvid.sources.generate import generate_links
from corvid.sources.sinks import write_centroids, write_ranks
from corvid.sources.text import labelled_postings, parse_adjacency, parse_vector, read_centroids, read_many, with_line_index
from corvid.session import checkpoint_dir, persist
from corvid.streaming import queue as event_queue
from corvid.streaming.route import route

# Fixed parameters of the catalog queries.
PR_ROUNDS = 10          # PageRank rounds (exact: delta < 0 never converges)
DAMPING = 0.85
OWNERS = 4              # owners that the rotation moves rows between
REGROUP_N = 8           # regroup destinations
ROUTE_WORKERS = 8       # event routing members
LINK_GROUP = 26         # generator group
FOREST_DEPTH = 4
FOREST_TREES = 5
FOREST_SUBSET = 3000    # features drawn per node
FOREST_SEED = 1
TOKEN_SPLIT = r"[ \t\n\r]+"
EMBED_DIM = 64
K_CENTRES = 10
MANY_CENTRES = 300
STORED_BUCKETS = 16
KM_ROUNDS = 3
PR_DELTA = 1e-9         # convergence threshold of the converging PageRank query
PR_MAX_ROUNDS = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------- graph


def _link_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int, int]:
    s = int(table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0]) + 1
    p = int(table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0]) + 1
    li = table(spark, sf_dir, "lineitem")
    links = li.select(F.col("l_suppkey").cast("bigint").alias("src"),
                      (F.lit(s) + F.col("l_partkey")).cast("bigint").alias("dst")).distinct()
    return links, s, s + p


def _pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, _, n = _link_graph(spark, sf_dir)
    g = pagerank.prepare_edges(links, n, distinct=False)
    res = pagerank.pagerank(g, damping=DAMPING, delta=-1.0, max_rounds=PR_ROUNDS)
    return res.ranks


def q_pagerank_all(spark, sf_dir):
    r = _pagerank(spark, sf_dir)
    return r.select("page", F.round("rank", 10).alias("rank"))


def q_pagerank_top(spark, sf_dir):
    r = graph.top_ranks(_pagerank(spark, sf_dir), 10)
    return r.select("page", F.round("rank", 10).alias("rank"))


def q_pagerank_seq(spark, sf_dir):
    """I2 rules (teleport (1-d)/M, float start, page M gets no dangling mass), ten
    parallel rounds."""
    links, _, n = _link_graph(spark, sf_dir)
    g = pagerank.prepare_edges(links, n, distinct=False, rules="sequential")
    r = pagerank.pagerank(g, damping=DAMPING, delta=-1.0, max_rounds=PR_ROUNDS).ranks
    return r.select("page", F.round("rank", 10).alias("rank"))


def q_pagerank_in_place(spark, sf_dir):
    """Ten rounds that update in place, as the sequential program does."""
    links, _, n = _link_graph(spark, sf_dir)
    g = pagerank.prepare_edges(links, n, distinct=False, rules="sequential")
    r = pagerank_in_place(g, PR_ROUNDS, DAMPING)
    return r.select("page", F.round("rank", 10).alias("rank"))


def q_pagerank_converge(spark, sf_dir):
    """I1 + G30: rounds until no rank moves more than PR_DELTA, the last change, and the
    rank total of the result."""
    links, _, n = _link_graph(spark, sf_dir)
    res = pagerank.pagerank(pagerank.prepare_edges(links, n, distinct=False), damping=DAMPING,
                            delta=PR_DELTA, max_rounds=PR_MAX_ROUNDS)
    return res.ranks.agg(F.lit(res.rounds).alias("rounds"), F.round(F.lit(res.max_change), 13).alias("max_change"),
                         F.round(F.sum("rank"), 12).alias("rank_sum"))


def q_out_degree_bag_set(spark, sf_dir):
    """P2 both ways over the raw (repeating) supplier -> part links of lineitem."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("bigint").alias("src"),
                                                 F.col("l_partkey").cast("bigint").alias("dst"))
    return graph.out_degree_edges(li).select(F.col("src").alias("page"), "bag", "set")


def q_dangling_pages(spark, sf_dir):
    links, _, n = _link_graph(spark, sf_dir)
    return graph.dangling_pages(links, n)


def q_top_ranks(spark, sf_dir):
    """T1 over the sequential-rules ranks: the ten highest, ties by page."""
    r = q_pagerank_seq(spark, sf_dir)
    return graph.top_ranks(r, 10)


def q_in_degree(spark, sf_dir):
    links, _, _ = _link_graph(spark, sf_dir)
    return graph.in_degree(links).select(F.col("dst").alias("page"), "in_degree")


def q_out_degree(spark, sf_dir):
    links, _, _ = _link_graph(spark, sf_dir)
    return graph.out_messages(links).select(F.col("src").alias("page"), "out_degree")


def q_graph_degrees(spark, sf_dir):
    links, _, _ = _link_graph(spark, sf_dir)
    return collectives.graph_degrees(links)


def q_max_node(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("bigint").alias("src"))
    return graph.max_node(li).select(F.col("max_id").alias("max_src"), F.col("n_nodes").alias("n_sources"))


def _as_int(df, *cols):
    """The 64-bit columns as the SQL's 32-bit ones; a value beyond 32 bits raises, as there."""
    wide = lambda c: F.raise_error(F.concat(F.lit(f"{c} beyond 32 bits: "), F.col(c).cast("string"))).cast("int")
    return df.withColumns({c: F.when(F.col(c).between(-(1 << 31), (1 << 31) - 1), F.col(c).cast("int")).otherwise(
        F.when(F.col(c).isNotNull(), wide(c))) for c in cols})


def q_generate_links(spark, sf_dir):
    n = table(spark, sf_dir, "supplier").count()
    adj = generate_links(spark, int(n), LINK_GROUP)
    return _as_int(graph.edges(adj), "src", "dst")


# ---------------------------------------------------------------------- keyed tables


def _cust_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("key"), F.lit(1).cast("bigint").alias("val"))


def _user_events(spark, sf_dir):
    """Event counts by user, every third user under an id no customer has: keys that
    match the customers, keys that don't, and customers without events."""
    u = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.when(u % 3 == 0, -u - 1).otherwise(u).alias("key"), F.lit(1).cast("bigint").alias("val"))


def _cust_global(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("key"), F.floor("c_acctbal").cast("bigint").alias("val"))


def q_word_average(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_type").alias("word"), F.floor(F.abs("value")).cast("int").alias("val"),
                    F.lit(1).alias("cnt"))
    return collectives.word_average(rows)


def q_combine_int(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    t = li.select(F.col("l_partkey").alias("key"), F.floor("l_quantity").cast("int").alias("val"))
    return keyed.combine_by_id(t, "key", plus("val"))


def q_combine_long(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = o.select(F.col("o_custkey").alias("key"), F.floor("o_totalprice").cast("bigint").alias("val"))
    return keyed.combine_by_id(t, "key", plus("val"))


def q_combine_double(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    t = li.select(F.col("l_orderkey").alias("key"),
                  (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("val"))
    return keyed.combine_by_id(t, "key", plus("val")).select("key", F.round("val", 4).alias("val"))


def q_combine_object(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    t = c.select(F.col("c_mktsegment").alias("key"), F.col("c_acctbal").alias("bal"), F.lit(1).alias("cnt"))
    return keyed.combine_by_id(t, "key", plus("bal", "cnt")).select("key", F.round("bal", 2).alias("bal"), "cnt")


def _embeddings(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))


def _long_form(df: DataFrame, key: str, col: str, *extra: str) -> DataFrame:
    return df.select(key, *extra, F.posexplode(col).alias("pos", "total")).select(
        key, F.col("pos").cast("int").alias("pos"), F.round("total", 6).alias("total"), *extra)


def q_array_sum(spark, sf_dir):
    t = _embeddings(spark, sf_dir).select("label", "vec")
    return _long_form(keyed.combine_by_id(t, "label", array_plus("vec", EMBED_DIM)), "label", "vec")


def q_allreduce_arrays(spark, sf_dir):
    """G18 with an array and a count combined together."""
    both = together(array_plus("vec", EMBED_DIM), plus("n"))
    merged = keyed.allreduce(_embeddings(spark, sf_dir).select("label", "vec", F.lit(1).alias("n")), "label", both)
    return _long_form(merged, "label", "vec", "n")


def q_push(spark, sf_dir):
    return keyed.push(_user_events(spark, sf_dir), _cust_global(spark, sf_dir), "key", plus("val"))


def q_pull(spark, sf_dir):
    local = keyed.combine_by_id(_user_events(spark, sf_dir), "key", plus("val"))
    return keyed.pull(local, _cust_global(spark, sf_dir), "key", plus("val"), on_missing="keep")


def q_push_pull_sync(spark, sf_dir):
    local = keyed.combine_by_id(_cust_orders(spark, sf_dir), "key", plus("val"))
    _, new_local = collectives.push_pull_sync(local, _cust_global(spark, sf_dir), "key", plus("val"))
    return new_local


def q_join_to_static(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_nationkey")
    o = _user_events(spark, sf_dir).select("key", F.col("val").alias("total"))
    j = keyed.join_to_static(o, c, "key", plus("total"), keep_unmatched=True)
    return j.select("key", "c_nationkey", "total")


def q_remove_val(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    return keyed.remove_val(c, _user_events(spark, sf_dir), "key")


def q_remove_returned(spark, sf_dir):
    """P6 / U2 again: orders minus the ids of orders with a returned line item."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey")
    returned = (table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
                .select(F.col("l_orderkey").alias("key")))
    return keyed.remove_val(o, returned, "key")


def q_get_val(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.lit(1).cast("bigint").alias("val"))
    counts = keyed.combine_by_id(lines, "key", plus("val"))
    return keyed.get_val(counts, keys, "key", {"val": 0})


def _key_tables(spark, sf_dir):
    """Three tables of counts by a customer's key: its orders, its users' events, itself."""
    n = F.lit(1).cast("bigint").alias("n")
    return [table(spark, sf_dir, t).select(F.lit(i).alias("owner"), F.col(c).alias("key"), n)
            for i, (t, c) in enumerate((("orders", "o_custkey"), ("events", "user_id"), ("customer", "c_custkey")))]


def q_allgather(spark, sf_dir):
    return keyed.allgather(_key_tables(spark, sf_dir), "key", plus("n"))


def q_reduce(spark, sf_dir):
    return keyed.reduce(_key_tables(spark, sf_dir), "key", plus("n"), root=0)


def q_gather(spark, sf_dir):
    return keyed.gather([keyed.combine_by_id(t, ["owner", "key"], plus("n")) for t in _key_tables(spark, sf_dir)])


def q_regroup_counts(spark, sf_dir):
    return keyed.regroup(_cust_orders(spark, sf_dir), "key", plus("val"), REGROUP_N)


def q_rotate_owner(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % OWNERS).cast("int").alias("owner"))
    return keyed.rotate_owner(o, OWNERS)


def q_partition_ids(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", keyed.partition_of("l_orderkey", REGROUP_N).alias("part"),
                     keyed.kv_partition_id(F.col("l_orderkey") * F.lit(4294967311), "long").alias("kv_part"))


# ------------------------------------------------------------------------- k-means


def _kmeans_inputs(spark, sf_dir, k=K_CENTRES):
    e = _embeddings(spark, sf_dir)
    starts = e.orderBy("vec_id").limit(k).select("vec_id", F.col("vec").alias("center"))
    rows = starts.collect()
    centres = [(i, [float(x) for x in r["center"]]) for i, r in enumerate(sorted(rows, key=lambda r: r["vec_id"]))]
    return e, centres


def q_kmeans_rounds(spark, sf_dir):
    """KM_ROUNDS full rounds from the ten lowest vec_id vectors; long form."""
    e = _embeddings(spark, sf_dir)
    starts = (e.orderBy("vec_id").limit(K_CENTRES)
              .select((F.row_number().over(Window.orderBy("vec_id")) - 1).cast("int").alias("cid"),
                      F.col("vec").alias("center"), F.lit(0).cast("bigint").alias("n")))
    res = kmeans.kmeans(e.select(F.col("vec").alias("features")), starts, KM_ROUNDS)
    return res.centroids.select("cid", "n", F.posexplode("center").alias("pos", "value")).select(
        "cid", F.col("pos").cast("int").alias("pos"), F.round("value", 6).alias("value"), "n")


def q_kmeans_assign(spark, sf_dir):
    e, centres = _kmeans_inputs(spark, sf_dir)
    a = kmeans.assign_nearest(e.select("vec_id", F.col("vec").alias("features")), centres)
    return a.select("vec_id", "cid", F.round("dist", 6).alias("dist"))


def q_kmeans_error(spark, sf_dir):
    e, centres = _kmeans_inputs(spark, sf_dir)
    a = kmeans.assign_nearest(e.select(F.col("vec").alias("features")), centres)
    return kmeans.clustering_error(a).select(F.round("error", 6).alias("error"))


def q_kmeans_1(spark, sf_dir):
    e, centres = _kmeans_inputs(spark, sf_dir)
    a = kmeans.assign_nearest(e.select(F.col("vec").alias("features")), centres)
    c = kmeans.new_centres(a, EMBED_DIM)
    return c.select("cid", "n", F.posexplode("center").alias("pos", "value")).select(
        "cid", F.col("pos").cast("int").alias("pos"), F.round("value", 6).alias("value"), "n")


# -------------------------------------------------------------------------- forest


def _postings(docs: DataFrame) -> DataFrame:
    return (docs.select(F.col("doc_id").alias("example"), F.explode(F.split("text", TOKEN_SPLIT)).alias("feature"))
            .filter(F.col("feature") != ""))


def _doc_data(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("example"), F.col("quality").alias("label"))
    docs = table(spark, sf_dir, "documents").join(lab.select(F.col("example").alias("doc_id")), "doc_id", "left_semi")
    return lab, _postings(docs)


def _root(spark, sf_dir, duplicates="bag", impurity="gini"):
    lab, post = _doc_data(spark, sf_dir)
    a = lab.select(F.lit(0).alias("tree"), F.lit(1).cast("bigint").alias("node"), "example", "label")
    return fo.scores(fo.weighted_postings(post, duplicates), a, impurity)


def _score_out(score):
    # The -1e30 sentinel passes unrounded (rounding it is not exact in every engine).
    return F.when(score == F.lit(fo.ABSENT), score).otherwise(F.round(score, 9))


def q_split_scores_entropy(spark, sf_dir):
    """G24 with G25: the entropy impurity (set postings, as it needs shares in 0..1)."""
    s = _root(spark, sf_dir, "set", "entropy")
    return s.select("feature", "m", "c", _score_out(F.col("score")).alias("score"))


def q_split_scores(spark, sf_dir):
    s = _root(spark, sf_dir)
    return s.select("feature", "m", "c", _score_out(F.col("score")).alias("score"))


def q_split_scores_set(spark, sf_dir):
    """G24 with repeated tokens counted once per document (``duplicates="set"``)."""
    s = _root(spark, sf_dir, "set")
    return s.select("feature", "m", "c", _score_out(F.col("score")).alias("score"))


def q_best_split(spark, sf_dir):
    b = fo.best_feature(_root(spark, sf_dir))
    return b.select("feature", _score_out(F.col("score")).alias("score"))


def _majority(spark, sf_dir, label):
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    j = lab.join(docs, "doc_id")
    g = j.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("pos"))
    return g.select("lang", "n", "pos", fo.majority(F.col("pos"), F.col("n")).alias("majority"),
                    fo.is_pure(F.col("pos"), F.col("n")).alias("pure"))


def q_majority(spark, sf_dir):
    return _majority(spark, sf_dir, "quality")


def q_majority_toxic(spark, sf_dir):
    """G23 where zeros outnumber ones."""
    return _majority(spark, sf_dir, "toxic")


def _forest_model(spark, sf_dir):
    """A forest on the labelled documents: set postings, each node's own draw."""
    lab, post = _doc_data(spark, sf_dir)
    return train_forest(lab, post, num_trees=FOREST_TREES, max_depth=FOREST_DEPTH, subset=FOREST_SUBSET, seed=FOREST_SEED,
                        duplicates="set"), lab


def _forest_predictions(spark, sf_dir):
    """Every document's prediction, labelled or not."""
    model, lab = _forest_model(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    return predict(model, docs.select(F.col("doc_id").alias("example")), _postings(docs)), lab


def q_tree_size(spark, sf_dir):
    """Mean number of nodes per tree (empty children count as leaves)."""
    model, _ = _forest_model(spark, sf_dir)
    return fo.mean_tree_size(model.nodes)


def q_forest_nodes(spark, sf_dir):
    """The trees themselves."""
    model, _ = _forest_model(spark, sf_dir)
    return model.nodes.select("tree", "node", "feature", "is_leaf", "prediction")


def q_forest_predict(spark, sf_dir):
    p, _ = _forest_predictions(spark, sf_dir)
    return p.select("example", "prediction")


def q_accuracy(spark, sf_dir):
    p, lab = _forest_predictions(spark, sf_dir)
    return fo.accuracy(p, lab).select("hits", "total", F.round("accuracy", 9).alias("accuracy"),
                                      "tp", "fp", "tn", "fn")


# --------------------------------------------------------------------- sources, events


def q_read_sparse_labeled(spark, sf_dir):
    """S4 over lines derived from ``orders`` (one line per order, example id = order key):
    ``label custkey:floor(totalprice) -day_of_month``."""
    o = table(spark, sf_dir, "orders")
    lines = o.select(
        F.col("o_orderkey").alias("line_no"),
        F.concat_ws(" ", F.when(F.col("o_orderstatus") == "F", "1").otherwise("0"),
                    F.concat(F.col("o_custkey").cast("string"), F.lit(":"),
                             F.floor("o_totalprice").cast("bigint").cast("string")),
                    (-F.dayofmonth("o_orderdate")).cast("string")).alias("value"))
    return _as_int(labelled_postings(lines), "feature", "label")


LINE_TARGETS = 4096   # targets of a line at most: a page's targets are distinct and cut by id


def _adjacency_lines(spark, sf_dir):
    """``src dst dst ...`` lines (targets in order, indented by a tab), one for each
    ``LINE_TARGETS`` target ids that a supplier links into, so no row holds a hot id's list."""
    links, _, n = _link_graph(spark, sf_dir)
    rows = links.groupBy("src", F.floor(F.col("dst") / F.lit(LINE_TARGETS)).alias("_c")).agg(
        F.array_sort(F.collect_list("dst")).alias("dst"))
    line = F.concat(F.lit("\t"), F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("array<string>")))
    return rows.select(line.alias("value")), n


def q_read_adjacency(spark, sf_dir):
    """S1 + P1: the adjacency lines parsed back to edges."""
    lines, _ = _adjacency_lines(spark, sf_dir)
    return _as_int(graph.edges(parse_adjacency(lines, "union")), "src", "dst")


def q_pagerank_adjacency(spark, sf_dir):
    """I1 by the adjacency route (a page that heads no line is dangling)."""
    lines, n = _adjacency_lines(spark, sf_dir)
    links = persist(graph.edges(parse_adjacency(lines, "union")))  # read for degrees, links and pages
    g = pagerank.prepare_edges(links, n, distinct=False)
    res = pagerank.pagerank(g, damping=DAMPING, delta=-1.0, max_rounds=PR_ROUNDS)
    links.unpersist()
    return res.ranks.select("page", F.round("rank", 10).alias("rank"))


def q_read_vectors(spark, sf_dir):
    """Embedding vectors written as lines and parsed back, long form."""
    e = _embeddings(spark, sf_dir)
    line = F.concat_ws(" ", F.transform("vec", lambda x: x.cast("string")))
    v = e.select("vec_id", parse_vector(line, EMBED_DIM).alias("vec"))
    return _long_form(v, "vec_id", "vec")


def q_combine_long_int(spark, sf_dir):
    """Int values summed by a long key."""
    li = table(spark, sf_dir, "lineitem")
    t = li.select((F.col("l_orderkey") * F.lit(4294967311)).alias("key"), F.col("l_linenumber").cast("int").alias("val"))
    return keyed.combine_by_id(t, "key", plus("val"))


def _array_sums(spark, sf_dir, kind):
    li = table(spark, sf_dir, "lineitem")
    vec = F.array(F.col("l_linenumber"), F.floor("l_quantity"), F.floor("l_extendedprice")).cast(f"array<{kind}>")
    s = keyed.combine_by_id(li.select("l_returnflag", vec.alias("vec")), "l_returnflag", array_plus("vec", 3))
    return s.select("l_returnflag", F.posexplode("vec").alias("pos", "total"))


def q_array_sum_int(spark, sf_dir):
    return _array_sums(spark, sf_dir, "int")


def q_array_sum_long(spark, sf_dir):
    return _array_sums(spark, sf_dir, "bigint")


def q_user_combiner(spark, sf_dir):
    """A user's own combiner (the longest priority name per customer) as a pandas UDF."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("val"))
    return keyed.combine_by_id(o, "key", grouped_udf(_longest, "val", "string"))


def _longest(v: pd.Series) -> str:
    return max(v, key=lambda x: (len(x), x))


def q_concat_lists(spark, sf_dir):
    """Per customer, the ids of its orders and of its users' events as one list."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("val"))
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("val"))
    return concat_lists(o, e)


def q_regroup_finish(spark, sf_dir):
    """Regroup with combine, then a finish function on every combined row."""
    half = {"val": F.floor(F.col("val") / 2).cast("bigint")}
    return keyed.regroup_aggregate(_user_events(spark, sf_dir), "key", plus("val"), half, REGROUP_N)


def q_reject_nulls(spark, sf_dir):
    """Rows whose derived value is null are not added."""
    t = _user_events(spark, sf_dir).withColumn("val", F.when(F.col("key") % 5 != 0, F.col("val")))
    return keyed.combine_by_id(keyed.reject_nulls(t, ["key", "val"]), "key", plus("val"))


def _event_rows(e):
    """Rows of the events table as messages between workers."""
    t = (F.when(F.col("event_type") == "view", F.lit("COLLECTIVE"))
         .when(F.col("event_type") == "purchase", F.lit("LOCAL")).otherwise(F.lit("MESSAGE")))
    return e.select("event_id", "ts", t.alias("type"), F.col("event_type").alias("context"),
                    (F.col("user_id") % ROUTE_WORKERS).cast("int").alias("source_id"),
                    (F.col("event_id") % ROUTE_WORKERS).cast("int").alias("target_id"),
                    F.when(F.col("value").isNotNull(), F.array("value")).alias("body"), "value")


def q_stream_route(spark, sf_dir):
    r = route(_event_rows(table(spark, sf_dir, "events")), ROUTE_WORKERS)
    return r.select("event_id", "type", "source_id", "target_id", "recipient", "value")


def q_kmeans_assign_many(spark, sf_dir):
    """J5 by groups of centres: every vector against the ``MANY_CENTRES`` lowest vec_ids."""
    e, centres = _kmeans_inputs(spark, sf_dir, MANY_CENTRES)
    a = kmeans.assign_nearest(e.select("vec_id", F.col("vec").alias("features")), centres, prune=True)
    return a.select("vec_id", "cid", F.round("dist", 6).alias("dist"))


def q_forest_files(spark, sf_dir):
    """The forest written as one binary row per tree and read back."""
    model, _ = _forest_model(spark, sf_dir)
    ids = number_features(model)
    back = trees_from_bytes(tree_bytes(model, ids), ids)
    return back.nodes.select("tree", "node", "depth", "feature", "is_leaf", "prediction")


def q_push_stored(spark, sf_dir):
    """J2 into a stored table: the customers, pushed into by two halves of the events."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/global-{uuid.uuid4().hex}"
    stored.create(_cust_global(spark, sf_dir), path, "key", plus("val"), STORED_BUCKETS)
    local = _user_events(spark, sf_dir)
    for half in (0, 1):
        stored.push(spark, path, local.filter(F.pmod("key", F.lit(2)) == half), "key", plus("val"), STORED_BUCKETS)
    return stored.read(spark, path, "key bigint, val bigint")


class _Activity(tasks.Task):
    """Per id: what it has, and an activity score from weights loaded at set-up."""

    def setup(self) -> None:
        self.weights = {"orders": 10, "events": 1}

    def run(self, left: pa.Table, right: pa.Table) -> pa.Table:
        both = left.join(right, "key", join_type="full outer")
        n = [pc.fill_null(both.column(c), 0) for c in ("orders", "events")]
        kind = pc.case_when(pc.make_struct(pc.equal(n[1], 0), pc.equal(n[0], 0)), "orders", "events", "both")
        score = pc.add(pc.multiply(n[0], self.weights["orders"]), pc.multiply(n[1], self.weights["events"]))
        return pa.table({"key": both.column("key"), "kind": kind, "score": score})


def q_task_activity(spark, sf_dir):
    """Tasks over two co-located tables: orders by customer, events by user."""
    orders = _cust_orders(spark, sf_dir).withColumnRenamed("val", "orders")
    events = _user_events(spark, sf_dir).withColumnRenamed("val", "events")
    return tasks.run_tasks(orders, events, "key", _Activity(), "key bigint, kind string, score bigint", plus("orders"), plus("events"))


def q_array_sum_wide(spark, sf_dir):
    """G8 by blocks of coordinates."""
    t = _embeddings(spark, sf_dir).select("label", "vec")
    return _long_form(sum_wide_arrays(t, "label", "vec", EMBED_DIM, block=24), "label", "vec")


WIDE = 4294967311   # times an id: beyond 32 bits


def q_read_adjacency_last(spark, sf_dir):
    """S1, last line wins, 64-bit ids: an order has a line of its parts per return flag."""
    li = table(spark, sf_dir, "lineitem")
    lists = li.groupBy("l_orderkey", "l_returnflag").agg(F.collect_list((F.col("l_partkey") * WIDE).cast("string")).alias("dst"))
    lines = lists.select(F.concat_ws(" ", (F.col("l_orderkey") * WIDE).cast("string"), "dst").alias("value"),
                         F.ascii("l_returnflag").alias("line_no"))
    return graph.edges(parse_adjacency(lines, "last"))


def q_read_sparse_labeled_wide(spark, sf_dir):
    """S4 with 64-bit features and labels."""
    o = table(spark, sf_dir, "orders")
    token = F.concat(F.lit("-"), (F.col("o_custkey") * WIDE).cast("string"), F.lit(":"), F.dayofmonth("o_orderdate").cast("string"))
    line = F.concat_ws(" ", (F.col("o_orderkey") * WIDE).cast("string"), token)
    return labelled_postings(o.select(F.col("o_orderkey").alias("line_no"), line.alias("value")))


def _new_folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_centroid_files(spark, sf_dir):
    """One round's centroids written as lines and read back; ``cid`` is the line."""
    e, centres = _kmeans_inputs(spark, sf_dir)
    path = _new_folder(spark, "centroids")
    write_centroids(kmeans.new_centres(kmeans.assign_nearest(e.select(F.col("vec").alias("features")), centres), EMBED_DIM), path)
    back = read_centroids(spark, path, EMBED_DIM)
    return back.select("cid", F.posexplode("center").alias("pos", "value")).select(
        "cid", F.col("pos").cast("int").alias("pos"), F.round("value", 6).alias("value"))


def _in_shares(spark, sf_dir):
    links, _, _ = _link_graph(spark, sf_dir)
    return graph.in_degree(links).select(F.col("dst").alias("page"), (F.col("in_degree") / F.lit(8.0)).alias("rank"))


def _rank_lines(lines):
    parts = F.split("value", "\t")
    return lines.select(parts[0].cast("bigint").alias("page"), parts[1].cast("double").alias("rank"),
                        *[c for c in lines.columns if c != "value"])


def q_rank_files(spark, sf_dir):
    """Ranks written in page order and read back with their line numbers."""
    path = _new_folder(spark, "ranks")
    write_ranks(_in_shares(spark, sf_dir), path)
    return _rank_lines(with_line_index(spark.read.text(path)))


def q_read_many(spark, sf_dir):
    """The lines of several inputs, odd and even pages written apart."""
    shares, paths = _in_shares(spark, sf_dir), [_new_folder(spark, "ranks") for _ in range(2)]
    for k, path in enumerate(paths):
        write_ranks(shares.filter(F.col("page") % 2 == k), path)
    return _rank_lines(read_many(spark, paths))


def q_ordered_ranks(spark, sf_dir):
    """Ranks by ascending page."""
    return graph.ordered_ranks(_in_shares(spark, sf_dir))


def q_table_ids(spark, sf_dir):
    """The ids that a table holds, and whether it and a table without rows are empty."""
    held = keyed.combine_by_id(_cust_orders(spark, sf_dir), "key", plus("val"))
    flags = keyed.is_empty(held), keyed.is_empty(held.filter(F.col("val") < 0))
    return keyed.ids(held, "key").select("key", F.lit(flags[0]).alias("is_empty"), F.lit(flags[1]).alias("none_left"))


def q_broadcast_table(spark, sf_dir):
    """A table of proven size, seen whole by every task."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(
        keyed.checked_broadcast(nation, 64 << 20), "c_nationkey", "left")


def q_lists_by_key(spark, sf_dir):
    """G12, lists kept: a customer's orders and its users' events, in lists of at most seven."""
    lists = lists_by_key(q_concat_lists(spark, sf_dir), "key", "val", F.expr("val div 1000"), 7)
    return lists.select("key", "chunk", F.posexplode("vals").alias("pos", "val"))


def _gcd(v: pd.Series) -> int:
    return int(np.gcd.reduce(v.to_numpy()))


def q_user_combiner_gcd(spark, sf_dir):
    """A combiner that no built-in aggregate has, the greatest common divisor."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key"), (F.col("l_quantity").cast("bigint") * 6).alias("val"))
    return keyed.combine_by_id(li, "key", grouped_udf(_gcd, "val", "bigint"))


def _queue_stream(spark, path, schema, **options):
    """Arrivals and requests of a stream over the events table. Every event is also a request
    by the workers ``event_id``, ``event_id + 1`` and ``event_id + 2`` (modulo their number):
    workers 0-3 poll, the others wait."""
    source = spark.readStream.schema(schema).options(**options).parquet(path)
    routed = route(_event_rows(source), ROUTE_WORKERS)
    asks = source.select("event_id", "ts", F.explode(F.array(*map(F.lit, range(3)))).alias("_j"))
    asks = asks.withColumn("_w", ((F.col("event_id") + F.col("_j")) % ROUTE_WORKERS).cast("int"))
    asks = asks.withColumn("_k", F.when(F.col("_w") < ROUTE_WORKERS // 2, event_queue.POLL).otherwise(event_queue.WAIT))
    return event_queue.arrivals(routed).unionByName(event_queue.requests(asks, "_w", "_k", "event_id"))


def _drained(spark, sf_dir):
    folder = sf_dir.rstrip("/")
    base = f"{checkpoint_dir(spark).rstrip('/')}/queues-{uuid.uuid4().hex}"
    # A pattern, as a stream's path may be a folder or a pattern but no single file.
    stream = _queue_stream(spark, f"{folder}/event[s].parquet", table(spark, folder, "events").schema)
    event_queue.start_queues(stream, f"{base}/state", f"{base}/numbered").awaitTermination()
    return f"{base}/numbered"


def q_event_queue(spark, sf_dir):
    """Every event that reached a worker's queue and the request that took it."""
    return event_queue.deliveries(spark, _drained(spark, sf_dir))


def q_event_queue_empty(spark, sf_dir):
    """The polls that found their queue empty and the waits still waiting."""
    sink = _drained(spark, sf_dir)
    empty = event_queue.empty_polls(spark, sink).select("worker", "request_id", F.lit("empty").alias("outcome"))
    return empty.unionByName(event_queue.waiting(spark, sink).select("worker", "request_id", F.lit("waiting").alias("outcome")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pagerank_top": q_pagerank_top,
    "pagerank_all": q_pagerank_all,
    "pagerank_seq": q_pagerank_seq,
    "pagerank_in_place": q_pagerank_in_place,
    "top_ranks": q_top_ranks,
    "pagerank_converge": q_pagerank_converge,
    "out_degree_bag_set": q_out_degree_bag_set,
    "dangling_pages": q_dangling_pages,
    "in_degree": q_in_degree,
    "out_degree": q_out_degree,
    "graph_degrees": q_graph_degrees,
    "max_node": q_max_node,
    "generate_links": q_generate_links,
    "word_average": q_word_average,
    "combine_int": q_combine_int,
    "combine_long": q_combine_long,
    "combine_double": q_combine_double,
    "combine_object": q_combine_object,
    "array_sum": q_array_sum,
    "allreduce_arrays": q_allreduce_arrays,
    "push": q_push,
    "pull": q_pull,
    "push_pull_sync": q_push_pull_sync,
    "join_to_static": q_join_to_static,
    "remove_val": q_remove_val,
    "remove_returned": q_remove_returned,
    "get_val": q_get_val,
    "allgather": q_allgather,
    "reduce": q_reduce,
    "gather": q_gather,
    "regroup_counts": q_regroup_counts,
    "rotate_owner": q_rotate_owner,
    "partition_ids": q_partition_ids,
    "kmeans_assign": q_kmeans_assign,
    "kmeans_error": q_kmeans_error,
    "kmeans_1": q_kmeans_1,
    "kmeans_rounds": q_kmeans_rounds,
    "split_scores": q_split_scores,
    "split_scores_entropy": q_split_scores_entropy,
    "forest_nodes": q_forest_nodes,
    "majority_toxic": q_majority_toxic,
    "read_adjacency": q_read_adjacency,
    "pagerank_adjacency": q_pagerank_adjacency,
    "read_vectors": q_read_vectors,
    "combine_long_int": q_combine_long_int,
    "array_sum_int": q_array_sum_int,
    "array_sum_long": q_array_sum_long,
    "user_combiner": q_user_combiner,
    "concat_lists": q_concat_lists,
    "regroup_finish": q_regroup_finish,
    "reject_nulls": q_reject_nulls,
    "split_scores_set": q_split_scores_set,
    "best_split": q_best_split,
    "majority": q_majority,
    "forest_predict": q_forest_predict,
    "accuracy": q_accuracy,
    "tree_size": q_tree_size,
    "read_sparse_labeled": q_read_sparse_labeled,
    "stream_route": q_stream_route,
    "read_adjacency_last": q_read_adjacency_last,
    "read_sparse_labeled_wide": q_read_sparse_labeled_wide,
    "centroid_files": q_centroid_files,
    "rank_files": q_rank_files,
    "read_many": q_read_many,
    "ordered_ranks": q_ordered_ranks,
    "table_ids": q_table_ids,
    "broadcast_table": q_broadcast_table,
    "lists_by_key": q_lists_by_key,
    "user_combiner_gcd": q_user_combiner_gcd,
    "kmeans_assign_many": q_kmeans_assign_many,
    "forest_files": q_forest_files,
    "push_stored": q_push_stored,
    "task_activity": q_task_activity,
    "array_sum_wide": q_array_sum_wide,
    "event_queue": q_event_queue,
    "event_queue_empty": q_event_queue_empty,
}
