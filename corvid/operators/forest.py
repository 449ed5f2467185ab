"""Forest building blocks on an inverted index.

Data are ``labels(example long, label int)`` and ``postings(feature, example long)``
(one row per occurrence; repeats are kept in ``"bag"`` mode as in the reference).
A node's examples are rows of an ``assignment(tree, node, example, label)`` table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.operators.keyed import numbered

ABSENT = -1e30  # score of a feature present on every example of the node (or absent)
WORD_BITS = 62  # slots in one word of a row's slot set


def gini(p: Column) -> Column:
    return p * (F.lit(1.0) - p)


def entropy(p: Column) -> Column:
    """G25, offered as ``impurity="entropy"``: 0 for a pure side; null outside 0..1 (bag
    counts can exceed the example counts: use set postings with it)."""
    part = lambda q: F.when(q > 0, q * F.log(q)).otherwise(F.lit(0.0))
    return F.when(p.between(0, 1), -(part(p) + part(F.lit(1.0) - p)))


def majority(pos: Column, n: Column) -> Column:
    """0 if zeros outnumber ones, else 1 (a tie or an empty set gives 1)."""
    return F.when((n - pos) > pos, F.lit(0)).otherwise(F.lit(1))


def is_pure(pos: Column, n: Column) -> Column:
    """All labels equal (an empty node is pure)."""
    return (pos == 0) | (pos == n)


def split_score(m: Column, c: Column, n: Column, pos: Column, impurity: str = "gini") -> Column:
    """Weighted impurity of the has-feature / lacks-feature split,
    ``m/n*g(c/m) + (n-m)/n*g((pos-c)/(n-m))``, and -1e30 when ``m == n``. ``m`` and ``c``
    count postings, so with repeats they can exceed the example counts (as in the
    reference)."""
    g = gini if impurity == "gini" else entropy
    m_d, n_d = m.cast("double"), n.cast("double")
    s = (m_d / n_d * g(c / m_d)
         + (n_d - m_d) / n_d * g((pos - c).cast("double") / F.when(n_d != m_d, n_d - m_d)))
    return F.when(m == n, F.lit(ABSENT)).otherwise(s)


def small_side(df: DataFrame, max_bytes: int = 64 << 20, rows: int | None = None) -> DataFrame:
    """A broadcast hint if the counted rows, at the longest string each, fit ``max_bytes``.
    ``rows``: a bound known beforehand (a node table without strings has one), not counted."""
    if rows is not None:
        return F.broadcast(df) if rows * (64 + 16 * len(df.columns)) <= max_bytes else df
    text = [c for c, t in df.dtypes if t == "string"]
    r = df.agg(F.count(F.lit(1)).alias("n"), *[F.max(F.octet_length(c)).alias(f"w{i}") for i, c in enumerate(text)]).first()
    width = 64 + 16 * len(df.columns) + sum(r[f"w{i}"] or 0 for i in range(len(text)))
    return F.broadcast(df) if r["n"] * width <= max_bytes else df


def present(fs: DataFrame, keys: Sequence[str] = ("tree", "node")) -> DataFrame:
    """The features counted at each (tree, node), numbered from 0: ``rank``. The order is by
    the first byte of the feature's MD5, then the feature, so that a node with very many
    features is numbered in 256 parts (see :func:`keyed.numbered`)."""
    part = F.substring(F.md5(F.col("feature").cast("string")), 1, 2)
    return numbered(fs.withColumn("_part", part), list(keys), "_part", ["feature"], "rank").drop("_part")


def draws(nodes: DataFrame, subset: int, seed: int) -> DataFrame:
    """``(tree, node, rank)``: what ``subset`` draws with replacement among a node's ``F``
    features take, each rank once. Draw i of a node is a hash of (seed, tree, node, i), so it
    is repeatable anywhere; a node takes at most ``subset`` features."""
    i = nodes.select("tree", "node", "F", F.explode(F.sequence(F.lit(0), F.lit(subset - 1))).alias("i"))
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("tree").cast("string"), F.col("node").cast("string"), F.col("i").cast("string")))
    u = F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))
    rank = F.least(F.floor(u * F.col("F")).cast("bigint"), F.col("F") - 1)
    return i.select("tree", "node", rank.alias("rank")).distinct()


def draw(fs: DataFrame, sizes: DataFrame, subset: int, seed: int, nodes: int | None = None) -> DataFrame:
    """The features that each (tree, node) draws, of those counted in ``fs`` (read twice:
    cache it). ``sizes`` is ``(tree, node, F)``; where ``fs`` has no tree, it is one node that
    all trees draw from. ``nodes``: a bound on the nodes, if known; the drawn ranks are
    broadcast if they are small, else joined."""
    taken = draws(sizes, subset, seed)
    taken = small_side(taken, rows=None if nodes is None else nodes * subset)
    keys = [c for c in ("tree", "node") if c in fs.columns]
    return present(fs, keys).join(taken, [*keys, "rank"]).select("tree", "node", "feature", "m", "c")


def slot_words(at: Column, slots: Sequence[Sequence[int | None]]) -> list[Column]:
    """The slots (nodes of a level, numbered over all trees) that a row is at, as bits of
    words: ``at`` is its node in every tree, ``slots`` the slot of each tree's nodes."""
    n = 1 + max(s for tree in slots for s in tree if s is not None)

    def word(first: int) -> Column:
        bits = constant([[1 << (s - first) if s is not None and first <= s < first + WORD_BITS else 0 for s in tree] for tree in slots],
                        "array<array<bigint>>")
        own = F.transform(at, lambda node, tree: F.get(F.get(bits, tree), node))
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))

    return [word(first).alias(f"w{i}") for i, first in enumerate(range(0, n, WORD_BITS))]


def _word_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c[0] == "w" and c[1:].isdigit()]


def seen_at(rows: DataFrame) -> DataFrame:
    """``(part, feature, w0, ...)`` of ``(feats, w0, ...)``: the slots at which each feature is
    present, one row per feature whatever the number of slots. ``part`` is the first byte of
    the feature's MD5, as in :func:`present`."""
    words = _word_names(rows)
    one = rows.select(F.explode("feats.feature").alias("feature"), *words)
    seen = one.groupBy("feature").agg(*[F.bit_or(w).alias(w) for w in words])
    part = F.conv(F.substring(F.md5(F.col("feature").cast("string")), 1, 2), 16, 10).cast("int")
    return seen.withColumn("part", F.coalesce(part, F.lit(-1)))


def slot_parts(seen: DataFrame) -> DataFrame:
    """``(slot, part, first, past)``: the ranks that a slot's features of each part take. The
    tasks send a number per part and slot."""
    words = _word_names(seen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((257, len(words) * WORD_BITS), np.int64)
        for b in batches:
            part = b.column(0).to_numpy() + 1
            for i in range(len(words)):
                word = b.column(i + 1).to_numpy()
                for bit in range(int(np.bitwise_or.reduce(word)).bit_length()):
                    held = part[(word >> bit) & 1 == 1]
                    if len(held):
                        n[:, i * WORD_BITS + bit] += np.bincount(held, minlength=257)
        part, slot = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(part - 1, pa.int32()), pa.array(n[part, slot])],
                                         ["slot", "part", "n"])

    n = seen.select("part", *words).mapInArrow(count, "slot int, part int, n bigint").groupBy("slot", "part").agg(F.sum("n").alias("n"))
    past = F.sum("n").over(Window.partitionBy("slot").orderBy("part"))
    return n.withColumn("past", past).select("slot", "part", (F.col("past") - F.col("n")).alias("first"), "past")


def draw_at(seen: DataFrame, nodes: DataFrame, subset: int, seed: int, most: int) -> DataFrame:
    """``(tree, node, slot, feature)``: what each (tree, node) draws of the features present at
    its slot, as :func:`draw`, but without a row per node and feature. ``nodes`` is
    ``(slot, tree, node)``, ``most`` rows at most; several may share a slot. ``seen`` (:func:`seen_at`) is read twice:
    cache it. A task sorts one of 256 parts of the features and counts along each slot's bits."""
    parts = slot_parts(seen)
    sizes = nodes.join(parts.groupBy("slot").agg(F.max("past").alias("F")), "slot")
    taken = draws(sizes.select("tree", "node", "F"), subset, seed).join(F.broadcast(nodes), ["tree", "node"])
    spans = small_side(parts.withColumnRenamed("slot", "_s"), rows=257 * most)
    taken = taken.join(spans, (F.col("slot") == F.col("_s")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")))
    taken = taken.select("part", "slot", "tree", "node", (F.col("rank") - F.col("first")).alias("rank"))

    def pick(features: pa.Table, asked: pa.Table) -> pa.Table:
        features = features.take(pc.sort_indices(features, [("feature", "ascending")], null_placement="at_start"))
        asked = asked.sort_by("slot")
        slot, rank = asked.column("slot").to_numpy(), asked.column("rank").to_numpy()
        place = np.zeros(len(slot), np.int64)
        edges = np.append(np.flatnonzero(np.diff(slot, prepend=-1)), len(slot))
        for i, j in zip(edges[:-1], edges[1:]):
            word = features.column(f"w{slot[i] // WORD_BITS}").to_numpy()
            place[i:j] = np.flatnonzero((word >> (slot[i] % WORD_BITS)) & 1)[rank[i:j]]
        cols = [asked.column(c) for c in ("tree", "node", "slot")]
        return pa.table([*cols, features.column("feature").take(pa.array(place))], ["tree", "node", "slot", "feature"])

    kind = dict(seen.dtypes)["feature"]
    return seen.groupBy("part").cogroup(taken.groupBy("part")).applyInArrow(pick, f"tree int, node bigint, slot int, feature {kind}")


def drawn_stats(rows: DataFrame, drawn: DataFrame, most: int) -> DataFrame:
    """J7 of drawn features only: ``(tree, node, feature, m, c)``. ``rows`` is
    ``(label, feats, w0, ...)``, ``drawn`` (read twice: cache it) has at most ``most`` rows."""
    words = _word_names(rows)
    asked = small_side(drawn.groupBy("feature").agg(F.collect_set("slot").alias("_slots")), rows=most)
    held = F.filter("_slots", lambda s: F.call_function("shiftright", F.get(F.array(*words), F.floor(s / WORD_BITS).cast("int")), s % WORD_BITS)
                    .bitwiseAND(F.lit(1).cast("bigint")) == 1)
    one = rows.select("label", F.explode("feats").alias("_f"), *words).select("label", F.col("_f.feature").alias("feature"), F.col("_f.k").alias("k"), *words)
    each = one.join(asked.withColumnRenamed("feature", "_a"), F.col("feature").eqNullSafe(F.col("_a"))).select("label", "feature", "k", F.explode(held).alias("slot"))
    fs = each.groupBy("slot", "feature").agg(F.sum("k").alias("m"), F.sum(F.col("k") * F.col("label")).alias("c"))
    fs = fs.withColumnsRenamed({"slot": "_s", "feature": "_a"})
    return drawn.join(fs, (F.col("slot") == F.col("_s")) & F.col("feature").eqNullSafe(F.col("_a"))).select("tree", "node", "feature", "m", "c")


def node_stats(assignment: DataFrame) -> DataFrame:
    """Examples and positives per (tree, node); totals come from labels, not postings, so
    an example without features still counts."""
    return assignment.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))


def weighted_postings(postings: DataFrame, duplicates: str = "bag") -> DataFrame:
    """Postings folded to ``(example, feature, k)`` with ``k`` occurrences (``"bag"``) or
    ``k = 1`` (``"set"``). Folding first keeps repeated tokens out of every later join."""
    g = postings.groupBy("example", "feature").agg(F.count(F.lit(1)).alias("k"))
    return g if duplicates == "bag" else g.withColumn("k", F.lit(1).cast("bigint"))


def feature_stats(wpostings: DataFrame, assignment: DataFrame) -> DataFrame:
    """J7 + G24 inputs: weighted postings joined to their examples' (tree, node, label),
    counted per (tree, node, feature): ``m`` postings, ``c`` positive postings. A hot
    example (one huge document) is a skewed join key; adaptive execution splits it."""
    j = wpostings.join(assignment, "example")
    return j.groupBy("tree", "node", "feature").agg(F.sum("k").alias("m"), F.sum(F.col("k") * F.col("label")).alias("c"))


def scores(wpostings: DataFrame, assignment: DataFrame, impurity: str = "gini") -> DataFrame:
    """Score of every feature present at every node: ``(tree, node, feature, m, c, n, pos, score)``."""
    fs = feature_stats(wpostings, assignment)
    ns = node_stats(assignment)
    return score_stats(fs, ns, impurity)


def score_stats(fs: DataFrame, ns: DataFrame, impurity: str = "gini", nodes: int | None = None) -> DataFrame:
    """G24 on counted features and node totals. There are as many totals as nodes in
    flight (``nodes`` at most); they are broadcast when that is checked small, so a level with one huge node
    doesn't shuffle its features to one task."""
    j = fs.join(small_side(ns, rows=nodes), ["tree", "node"])
    return j.select("tree", "node", "feature", "m", "c", "n", "pos",
                    split_score(F.col("m"), F.col("c"), F.col("n"), F.col("pos"), impurity).alias("score"))


def best_feature(scored: DataFrame) -> DataFrame:
    """The lowest score per (tree, node); equal scores go to the lowest feature id."""
    b = scored.filter(F.col("score").isNotNull()).groupBy("tree", "node").agg(F.min(F.struct("score", "feature")).alias("b"))
    return b.select("tree", "node", F.col("b.feature").alias("feature"), F.col("b.score").alias("score"))


@dataclass
class Walk:
    """Trees as constants of an expression: of each tree (outer list) and node (inner list,
    node 0 is the root) the tested feature (None at a leaf) and the children's indexes."""

    feature: list[list]
    left: list[list[int]]
    right: list[list[int]]

    def used(self) -> list:
        return sorted({f for tree in self.feature for f in tree if f is not None})

    def at(self, names: Column, depth: int, ftype: str) -> Column:
        """The node that a row with the features ``names`` reaches in each tree, an array
        over trees: left if it has the node's feature, else right. No join and no exchange:
        the whole walk is one expression over the row."""
        feature, left, right = (constant(v, f"array<array<{t}>>") for v, t in
                                ((self.feature, ftype), (self.left, "int"), (self.right, "int")))
        mine = F.array_intersect(names, constant(self.used(), f"array<{ftype}>"))
        if not depth:
            return F.transform(constant(list(range(len(self.feature))), "array<int>"), lambda t: F.lit(0))

        trees, levels = (constant(list(range(n)), "array<int>") for n in (len(self.feature), depth))
        walk = lambda m: F.transform(trees, lambda t: F.aggregate(levels, F.lit(0), lambda node, _: F.when(
            F.get(F.get(feature, t), node).isNull(), node).when(F.array_contains(m, F.get(F.get(feature, t), node)), F.get(F.get(left, t), node))
            .otherwise(F.get(F.get(right, t), node))))
        return F.get(F.transform(F.array(mine), walk), 0)


def constant(value, kind: str) -> Column:
    """A nested list as one constant (parsed once, when the plan is optimised)."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def vote(predictions: DataFrame) -> DataFrame:
    """Per example, 0 if more trees say 0 than 1, else 1."""
    g = predictions.groupBy("example").agg(F.count(F.lit(1)).alias("_n"), F.sum("prediction").alias("_p"))
    return g.select("example", majority(F.col("_p"), F.col("_n")).alias("prediction"))


def accuracy(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Hits / total plus the confusion counts."""
    j = predictions.join(labels, "example")
    p, y = F.col("prediction"), F.col("label")
    return j.agg(F.count_if(p == y).alias("hits"), F.count(F.lit(1)).alias("total"),
                 (F.count_if(p == y) / F.count(F.lit(1))).alias("accuracy"),
                 F.count_if((p == 1) & (y == 1)).alias("tp"), F.count_if((p == 1) & (y == 0)).alias("fp"),
                 F.count_if((p == 0) & (y == 0)).alias("tn"), F.count_if((p == 0) & (y == 1)).alias("fn"))


def mean_tree_size(nodes: DataFrame) -> DataFrame:
    """Nodes per tree, averaged over trees."""
    return nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("_s")).agg(F.avg("_s").alias("mean_size"))


def tree_ranges(spark, num_trees: int, splits: int = 2) -> DataFrame:
    """Trees cut into ``splits`` ranges of ``ceil(num_trees / splits)``."""
    per = -(-num_trees // max(splits, 1))
    return spark.range(num_trees).select(F.col("id").cast("int").alias("tree"),
                                         (F.col("id") / F.lit(per)).cast("int").alias("split"))
