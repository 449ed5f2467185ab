"""Random forest on sparse binary features.

The reference trains each tree recursively on one machine with all data copied to every
task. Here all trees grow together, level by level. The postings are shuffled once, into one
row per example with its features. The trees grown so far are constants of an expression that
walks a row to its node in every tree, so routing (J6) needs no join and no exchange: a level
counts its nodes' examples, marks for each feature the nodes at which it is present (one row per
feature, a bit per node, whatever the number of trees), draws along the bits, counts the drawn
features alone in a second scan, and picks the best split. Only the level's nodes reach the
driver, at most trees x 2^depth of them, the size of the model itself.

Semantics kept from the reference: no bootstrap (every tree sees every row); a node is a
leaf at ``max_depth``, when pure, or when its best (lowest) score is ``<= 0`` — so a
feature on every example of the node (score -1e30) or a perfect split (score 0) ends the
branch in ``mode="reference"``; ``mode="gini"`` ignores -1e30 candidates and splits on 0.
Each node draws ``subset`` of the features present at it, with replacement, before any is
scored: the features are numbered, and a hash of (seed, tree, node, draw) gives the number
that a draw takes. With ``subset=None`` every feature is drawn, so all trees are one tree,
which is grown once and labelled with every tree id. Ties between equal scores go to the
lowest feature id. Nodes are numbered as in a heap (root 1, children 2n and 2n + 1).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.operators import forest as fo
from corvid.session import persist


@dataclass
class ForestModel:
    nodes: DataFrame        # tree int, node bigint, depth int, feature (as the postings'), is_leaf boolean, prediction int
    num_trees: int
    max_depth: int
    identical: bool         # every tree is the same tree


class _Tree:
    """A growing tree: node 0 is the root, ``heap`` holds the nodes' heap numbers."""

    def __init__(self):
        self.heap, self.depth, self.feature, self.left, self.right, self.prediction = [1], [0], [None], [-1], [-1], [None]
        self.open = [0]   # nodes of the current level that may still split

    def child(self, parent: int, side: int) -> int:
        for values, v in ((self.heap, 2 * self.heap[parent] + side), (self.depth, self.depth[parent] + 1), (self.feature, None),
                          (self.left, -1), (self.right, -1), (self.prediction, None)):
            values.append(v)
        return len(self.heap) - 1


def example_rows(labels: DataFrame, postings: DataFrame, duplicates: str) -> DataFrame:
    """``(example, label, feats array<struct<feature, k>>)``: the one exchange of postings. An
    example is one row, as a document is; one without features has an empty list.

    The exchange's width is set here: every level scans these rows and makes many more of them
    (trees x features), so they must not be coalesced to the few tasks that their own bytes ask for."""
    spark = labels.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    postings, labels = postings.repartition(width, "example"), labels.repartition(width, "example")
    if duplicates == "set":
        lists = postings.groupBy("example").agg(F.collect_set("feature").alias("_f")).select(
            "example", F.transform("_f", lambda f: F.struct(f.alias("feature"), F.lit(1).cast("bigint").alias("k"))).alias("feats"))
    else:  # partitioned by example, both aggregates need no further exchange
        counts = postings.groupBy("example", "feature").agg(F.count(F.lit(1)).alias("k"))
        lists = counts.groupBy("example").agg(F.collect_list(F.struct("feature", "k")).alias("feats"))
    kind = dict(lists.dtypes)["feats"]
    return labels.select("example", F.col("label").cast("int").alias("label")).join(lists, "example", "left").withColumn(
        "feats", F.coalesce("feats", F.array().cast(kind)))


def _grow(rows: DataFrame, first_tree: int, last_tree: int, ftype: str, max_depth: int, subset: int | None, seed: int,
          mode: str, impurity: str) -> list[_Tree]:
    trees = [_Tree() for _ in range(first_tree, last_tree + 1)]
    names = F.col("feats.feature")
    for depth in range(max_depth + 1):
        if not any(t.open for t in trees):
            break
        same = depth == 0  # every tree has the same root: count it once
        live = trees[:1] if same else trees
        at = fo.Walk(*([getattr(t, c) for t in live] for c in ("feature", "left", "right"))).at(names, depth, ftype)
        # Of each tree, the heap number of the row's node if that is open, else null.
        heap = fo.constant([[t.heap[i] if i in set(t.open) else None for i in range(len(t.heap))] for t in live], "array<array<bigint>>")
        placed = rows.select("label", "feats", F.posexplode(at).alias("tree", "_i")).select(
            "label", "feats", F.col("tree").cast("int").alias("tree"), F.get(F.get(heap, F.col("tree")), F.col("_i")).alias("node"))
        found = {(r["tree"], r["node"]): (r["n"], r["pos"]) for r in fo.node_stats(
            placed.filter(F.col("node").isNotNull()).select("tree", "node", "label")).collect()}
        split: list[dict[int, tuple[int, int]]] = [{} for _ in trees]
        for k, t in enumerate(trees):
            for i in t.open:
                n, pos = found.get((0 if same else k, t.heap[i]), (0, 0))
                t.prediction[i] = 0 if n - pos > pos else 1   # an empty node predicts 1
                if depth < max_depth and 0 < pos < n:
                    split[k][i] = (n, pos)
        totals = [(k, t.heap[i], *split[k][i]) for k, t in enumerate(trees) for i in split[k]]
        for t in trees:
            t.open = []
        if not totals:
            break
        spark = rows.sparkSession
        ns = spark.createDataFrame([(k + first_tree, *v) for k, *v in totals], "tree int, node bigint, n bigint, pos bigint")
        if subset is None:
            impure = fo.constant([[t.heap[i] if i in split[k] else None for i in range(len(t.heap))] for k, t in enumerate(live)],
                                 "array<array<bigint>>")
            counted = rows.select("label", "feats", F.posexplode(at).alias("tree", "_i")).select(
                "label", "feats", F.col("tree").cast("int").alias("tree"), F.get(F.get(impure, F.col("tree")), F.col("_i")).alias("node")).filter(
                F.col("node").isNotNull()).select("label", "tree", "node", F.explode("feats").alias("_f"))
            drawn = counted.groupBy("tree", "node", F.col("_f.feature").alias("feature")).agg(
                F.sum("_f.k").alias("m"), F.sum(F.col("_f.k") * F.col("label")).alias("c"))
            kept = []
        else:
            ids = {key: s for s, key in enumerate((k, i) for k in range(len(live)) for i in split[k])}
            slots = [[ids.get((k, i)) for i in range(len(t.heap))] for k, t in enumerate(live)]
            counted = rows.select("label", "feats", *fo.slot_words(at, slots))
            counted = counted.filter(" or ".join(f"{w} != 0" for w in counted.columns[2:]))
            of = [(0 if same else ids[k, i], k + first_tree, t.heap[i]) for k, t in enumerate(trees) for i in split[k]]
            of = spark.createDataFrame(of, "slot int, tree int, node bigint")
            seen = persist(fo.seen_at(counted))
            picked = persist(fo.draw_at(seen, of, subset, seed, len(totals)))
            drawn = fo.drawn_stats(counted, picked, len(totals) * subset)
            kept = [seen, picked]
        scored = fo.score_stats(drawn, ns, impurity, len(totals))
        if mode == "gini":
            scored = scored.filter(F.col("score") > F.lit(fo.ABSENT))
        best = {(r["tree"] - first_tree, r["node"]): r for r in fo.best_feature(scored).collect()}  # at most one row per node
        for df in kept:
            df.unpersist()
        for k, t in enumerate(trees):
            for i in split[k]:
                r = best.get((k, t.heap[i]))
                if r is None or (mode == "reference" and r["score"] <= 0):
                    continue
                t.feature[i], t.prediction[i] = r["feature"], None
                t.left[i], t.right[i] = t.child(i, 0), t.child(i, 1)
                t.open += [t.left[i], t.right[i]]
    return trees


def train_forest(labels: DataFrame, postings: DataFrame, num_trees: int = 50, max_depth: int = 8,
                 subset: int | None = 30000, seed: int = 0, mode: str = "reference", impurity: str = "gini",
                 duplicates: str = "bag", tree_batch: int | None = None) -> ForestModel:
    """``labels(example, label)``, ``postings(feature, example)`` -> node table.

    Per level the work is (trees in flight) x postings, so ``tree_batch`` grows the trees
    in ranges of that many (I10's tree ranges); the hashed draws depend only on tree ids,
    so the forest is the same however it is batched."""
    rows = persist(example_rows(labels, postings, duplicates))
    identical = subset is None
    ftype = dict(postings.dtypes)["feature"]
    if identical:
        ranges = [(0, 0)]
    else:
        step = max(1, tree_batch or num_trees)
        ranges = [(t, min(t + step, num_trees) - 1) for t in range(0, num_trees, step)]
    out = []
    for t0, t1 in ranges:
        for k, t in enumerate(_grow(rows, t0, t1, ftype, max_depth, subset, seed, mode, impurity)):
            ids = range(num_trees) if identical else [t0 + k]
            out += [(tree, *v) for tree in ids for v in zip(t.heap, t.depth, t.feature, [f is None for f in t.feature], t.prediction)]
    rows.unpersist()
    nodes = labels.sparkSession.createDataFrame(
        out, f"tree int, node bigint, depth int, feature {ftype}, is_leaf boolean, prediction int")
    return ForestModel(nodes, num_trees, max_depth, identical)


def _walk_of(model: ForestModel) -> tuple[fo.Walk, list[list[int | None]]]:
    """The node table (trees x 2^depth rows at most) as constants, and the predictions."""
    nodes = model.nodes.filter(F.col("tree") == 0) if model.identical else model.nodes
    trees: dict[int, list] = {}
    for r in nodes.select("tree", "node", "feature", "is_leaf", "prediction").collect():
        trees.setdefault(r["tree"], []).append(r)
    walk, predictions = fo.Walk([], [], []), []
    for _, rows in sorted(trees.items()):
        rows.sort(key=lambda r: r["node"])  # the root first
        place = {r["node"]: i for i, r in enumerate(rows)}
        inner = [not r["is_leaf"] for r in rows]
        walk.feature.append([r["feature"] if x else None for r, x in zip(rows, inner)])
        walk.left.append([place[2 * r["node"]] if x else -1 for r, x in zip(rows, inner)])
        walk.right.append([place[2 * r["node"] + 1] if x else -1 for r, x in zip(rows, inner)])
        predictions.append([r["prediction"] for r in rows])
    return walk, predictions


def predict(model: ForestModel, examples: DataFrame, postings: DataFrame, per_tree: bool = False) -> DataFrame:
    """Walk every tree (has feature? left : right) and vote.

    ``examples`` has an ``example`` column; ``postings(feature, example)``. The postings are
    cut down to the features that the trees test before their one exchange, to a set per
    example (at most one feature per inner node); all trees are walked and the votes counted
    within the row. When all trees are the same tree only one is walked (its vote is
    unanimous)."""
    walk, predictions = _walk_of(model)
    ftype = dict(postings.dtypes)["feature"]
    tested = postings.sparkSession.createDataFrame([(f,) for f in walk.used()], f"feature {ftype}")
    sets = postings.join(fo.small_side(tested), "feature", "left_semi").groupBy("example").agg(F.collect_set("feature").alias("_f"))
    rows = examples.select(F.col("example").cast("bigint")).join(sets.withColumn("example", F.col("example").cast("bigint")), "example", "left")
    names = F.coalesce("_f", F.array().cast(f"array<{ftype}>"))
    says = fo.constant(predictions, "array<array<int>>")
    votes = F.transform(walk.at(names, model.max_depth, ftype), lambda node, tree: F.get(F.get(says, tree), node))
    if per_tree:
        got = rows.select("example", F.posexplode(votes).alias("tree", "prediction"))
        return got.select("tree", "example", "prediction")
    pos = F.aggregate("_v", F.lit(0), lambda s, v: s + v)
    return rows.select("example", votes.alias("_v")).select(
        "example", fo.majority(pos, F.size("_v")).alias("prediction"))


def number_features(model: ForestModel) -> DataFrame:
    """``(feature, id int)`` of the features that the model tests (at most one per inner
    node), for tree files, which hold 32-bit ids. Ids follow the features' order."""
    used = model.nodes.filter(F.col("feature").isNotNull()).select("feature").distinct()
    return used.select("feature", (F.row_number().over(Window.orderBy("feature")) - 1).cast("int").alias("id"))


def tree_bytes(model: ForestModel, ids: DataFrame | None = None) -> DataFrame:
    """``(tree, data binary)``, one row per tree in the reference's file format: the depth
    limit, then the nodes in preorder, each a byte that says whether it is a leaf, followed by
    the leaf's prediction or by the feature and both subtrees (big-endian 32-bit numbers).
    ``ids`` is ``(feature, id)`` for features that are no 32-bit numbers themselves."""
    nodes = model.nodes
    if ids is None:
        feature = F.when(F.col("feature").isNull() | F.col("feature").between(-(1 << 31), (1 << 31) - 1), F.col("feature")).otherwise(
            F.raise_error(F.concat(F.lit("tree file: feature beyond 32 bits: "), F.col("feature").cast("string"))).cast("bigint"))
    else:
        nodes = nodes.join(fo.small_side(ids), "feature", "left")
        feature = F.col("id")
    depth = model.max_depth

    def write(table: pa.Table) -> pa.Table:
        rows = {n: (leaf, f, p) for n, leaf, f, p in zip(*(table.column(c).to_pylist() for c in ("node", "is_leaf", "feature", "prediction")))}
        out, todo = [struct.pack(">i", depth)], [1]
        while todo:
            n = todo.pop()
            leaf, f, p = rows[n]
            out.append(struct.pack(">?i", leaf, p if leaf else f))
            if not leaf:
                todo += [2 * n + 1, 2 * n]
        return pa.table({"tree": table.column("tree")[:1], "data": pa.array([b"".join(out)], pa.binary())})

    return nodes.select("tree", "node", "is_leaf", feature.cast("int").alias("feature"), "prediction").groupBy("tree").applyInArrow(
        write, "tree int, data binary")


def trees_from_bytes(trees: DataFrame, ids: DataFrame | None = None) -> ForestModel:
    """A model from ``(tree int, data binary)`` rows. Each file is read with a stack of the
    nodes still to come; a file that ends early or goes on after the last leaf fails."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, data in zip(b.column("tree").to_pylist(), b.column("data").to_pylist()):
                got, todo, at = [], [(1, 0)], 4
                while todo:
                    node, depth = todo.pop()
                    leaf, value = struct.unpack_from(">?i", data, at)
                    at += 5
                    got.append((tree, node, depth, None if leaf else value, leaf, value if leaf else None))
                    if not leaf:
                        todo += [(2 * node + 1, depth + 1), (2 * node, depth + 1)]
                if at != len(data):
                    raise ValueError(f"tree file: {len(data) - at} bytes after the last node of tree {tree}")
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), kinds)],
                                                 ["tree", "node", "depth", "feature", "is_leaf", "prediction"])

    nodes = trees.select("tree", "data").mapInArrow(
        read, "tree int, node bigint, depth int, feature int, is_leaf boolean, prediction int")
    if ids is not None:
        names = fo.small_side(ids.select(F.col("id").alias("feature"), F.col("feature").alias("_name")))
        nodes = nodes.join(names, "feature", "left").withColumn("feature", F.col("_name"))
    facts = trees.agg(F.count(F.lit(1)).alias("n"), F.max(F.conv(F.hex(F.substring("data", 1, 4)), 16, 10).cast("int")).alias("d")).first()
    return ForestModel(nodes.select("tree", "node", "depth", "feature", "is_leaf", "prediction"), facts["n"], facts["d"] or 0, False)


def save_forest(model: ForestModel, path: str) -> None:
    """Node rows as Parquet (instead of the reference's preorder binary), and beside
    them the model's facts."""
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    facts = [(model.num_trees, model.max_depth, model.identical)]
    model.nodes.sparkSession.createDataFrame(facts, "num_trees int, max_depth int, identical boolean").write.mode(
        "overwrite").parquet(f"{path}/facts")


def load_forest(spark: SparkSession, path: str) -> ForestModel:
    r = spark.read.parquet(f"{path}/facts").first()
    return ForestModel(spark.read.parquet(f"{path}/nodes"), r["num_trees"], r["max_depth"], r["identical"])
