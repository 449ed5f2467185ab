"""Stored global tables, tasks over co-located tables, wide array sums, tree files, many centres."""

import os
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvid.functions.combiners import plus, sum_wide_arrays
from corvid.operators import stored, tasks
from corvid.plans import kmeans
from corvid.plans.forest import number_features, predict, train_forest, tree_bytes, trees_from_bytes

KV = "key bigint, val bigint"


def files(path):
    return {os.path.join(os.path.basename(d), f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_two_pushes_equal_one_and_other_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "global")
    base = [(i, i) for i in range(200)] + [(3, 100)]
    stored.create(spark.createDataFrame(base, KV), path, "key", plus("val"), 8)
    before = files(path)
    first, second = [(5, 1)] * 500 + [(900, 2), (None, 4)], [(5, 10), (901, 1), (None, 6)]   # a hot key, new keys, a null key
    touched = set(stored.push(spark, path, spark.createDataFrame(first, KV), "key", plus("val"), 8))
    after = files(path)
    kept = {f for f in before if int(f.split("=")[1].split("/")[0]) not in touched}
    assert len(touched) <= 3 and kept and kept <= after and not (before - kept) & after
    stored.push(spark, path, spark.createDataFrame(second, KV), "key", plus("val"), 8)
    want = {}
    for k, v in base + first + second:
        want[k] = want.get(k, 0) + v
    rows = stored.read(spark, path, KV).collect()
    assert {r.key: r.val for r in rows} == want and len(rows) == len(want)
    names = files(path)
    assert stored.push(spark, path, spark.createDataFrame([], KV), "key", plus("val"), 8) == [] and files(path) == names


def test_push_into_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    stored.create(spark.createDataFrame([], KV), path, "key", plus("val"), 4)
    assert stored.read(spark, path, KV).collect() == []
    stored.push(spark, path, spark.createDataFrame([(1, 2)], KV), "key", plus("val"), 4)
    assert [tuple(r) for r in stored.read(spark, path, KV).collect()] == [(1, 2)]


def marked():
    # Made here, so that it is sent to the workers by value.
    class Marked(tasks.Task):
        """Notes how often it was set up in its worker; sees pieces of at most one row per key."""

        def setup(self):
            self.ready = getattr(self, "ready", 0) + 1

        def run(self, left, right):
            a, b = (dict(zip(t.column("key").to_pylist(), t.column("val").to_pylist())) for t in (left, right))
            assert len(a) == left.num_rows and len(b) == right.num_rows
            keys = sorted({*a, *b}, key=str)
            return pa.table({"key": pa.array(keys, pa.int64()), "val": pa.array([a.get(k, 0) - b.get(k, 0) for k in keys], pa.int64()),
                             "setups": pa.array([self.ready] * len(keys), pa.int64()), "rows": pa.array([left.num_rows + right.num_rows] * len(keys), pa.int64())})

    return Marked()


def test_tasks_see_both_tables_and_are_set_up_once(spark):
    left = [(i % 300, 1) for i in range(3000)] + [(7, 1)] * 2000 + [(None, 5)]   # a hot key
    right = [(i, i) for i in range(250, 400)]
    out = tasks.run_tasks(spark.createDataFrame(left, KV), spark.createDataFrame(right, KV), "key", marked(),
                          "key bigint, val bigint, setups bigint, rows bigint", plus("val"), rows_per_task=40).collect()
    want = {}
    for k, v in left:
        want[k] = want.get(k, 0) + v
    for k, v in right:
        want[k] = want.get(k, 0) - v
    assert {r.key: r.val for r in out} == want and len(out) == len(want)
    assert {r.setups for r in out} == {1} and max(r["rows"] for r in out) < 120


def test_wide_sums(spark):
    width = 100_000
    df = spark.range(6).select((F.col("id") % 2).alias("k"), F.transform(F.sequence(F.lit(1), F.lit(width)), lambda x: (x * (F.col("id") + 1)).cast("bigint")).alias("v"))
    got = {r.k: r.v for r in sum_wide_arrays(df.repartition(3), "k", "v", width).collect()}
    base = np.arange(1, width + 1)
    assert np.array_equal(got[0], base * 9) and np.array_equal(got[1], base * 12) and len(got) == 2


@pytest.mark.parametrize("held", [64 << 20, 1])
def test_wide_sums_of_hot_null_and_double_keys(spark, held):
    rows = [("hot", [0.5, 1.0, 2.0, 4.0, 8.0])] * 300 + [(None, [1.0] * 5), (None, [2.0] * 5), ("x", [0.0, -1.0, 0.0, 0.0, 9.0])]
    df = spark.createDataFrame(rows, "k string, v array<double>").repartition(4)
    got = {r.k: r.v for r in sum_wide_arrays(df, "k", "v", 5, block=2, held=held).collect()}
    assert got == {"hot": [150.0, 300.0, 600.0, 1200.0, 2400.0], None: [3.0] * 5, "x": [0.0, -1.0, 0.0, 0.0, 9.0]}
    assert sum_wide_arrays(df.limit(0), "k", "v", 5).collect() == []
    for bad in ([1.0], [1.0, None, 1.0, 1.0, 1.0], None):
        with pytest.raises(Exception, match="array_plus"):
            sum_wide_arrays(spark.createDataFrame([("a", bad)], "k string, v array<double>"), "k", "v", 5).collect()


def test_tree_files_round_trip(spark):
    lab = spark.createDataFrame([(i, int(i % 3 == 0 or i % 7 == 1)) for i in range(80)], "example long, label int")
    post = spark.createDataFrame([(f, i) for i in range(80) for f in range(2, 9) if i % f == 0], "feature int, example long")
    model = train_forest(lab, post, num_trees=3, max_depth=4, subset=3, seed=5, duplicates="set")
    files_ = tree_bytes(model)
    back = trees_from_bytes(files_)
    rows = lambda m: sorted(map(tuple, m.nodes.collect()), key=str)
    assert rows(back) == rows(model) and (back.num_trees, back.max_depth) == (3, 4)
    assert {tuple(r) for r in predict(back, lab, post).collect()} == {tuple(r) for r in predict(model, lab, post).collect()}
    data = next(r.data for r in files_.collect() if r.tree == 0)
    root = next(r for r in model.nodes.collect() if r.tree == 0 and r.node == 1)
    assert struct.unpack(">i?i", data[:9]) == (4, False, root.feature) and len(data) == 4 + 5 * sum(r[0] == 0 for r in rows(model))
    for bad in (data[:-1], data + b"\0"):
        with pytest.raises(Exception, match="tree file|unpack_from"):
            trees_from_bytes(spark.createDataFrame([(0, bytearray(bad))], "tree int, data binary")).nodes.collect()
    named = post.withColumn("feature", F.concat(F.lit("f"), "feature"))
    words = train_forest(lab, named, num_trees=2, max_depth=3, subset=3, seed=5, duplicates="set")
    ids = number_features(words)
    assert rows(trees_from_bytes(tree_bytes(words, ids), ids)) == rows(words)


def test_many_centres_equal_the_full_search_with_few_distances(spark):
    """The width of the reference's points (3), 5000 centres."""
    rng = np.random.default_rng(1)
    centres, x = rng.uniform(0, 10, (5000, 3)), rng.uniform(-1, 11, (3000, 3))
    centres[4000:4100] = centres[:100]          # equal centres: the first counts
    x[:50] = centres[100:150]
    x[50] = np.nan
    want, dist = kmeans._nearest(x, centres)
    at, d, count = kmeans._nearest_of_many(x, kmeans.Groups(centres))
    assert np.array_equal(at, want) and np.array_equal(d, dist, equal_nan=True)
    assert count * 5 < len(x) * len(centres)
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:400])], "id int, features array<double>")
    cs = [(i, c.tolist()) for i, c in enumerate(centres)]
    both = [sorted((r.id, r.cid) for r in kmeans.assign_nearest(pts, cs, prune=p).collect()) for p in (True, False)]
    assert both[0] == both[1]


@pytest.mark.parametrize("k,dim", [(1, 2), (2, 1), (70, 64), (300, 8)])
def test_group_search_in_other_shapes(k, dim):
    rng = np.random.default_rng(k)
    centres, x = rng.normal(size=(k, dim)).round(1), rng.normal(size=(200, dim)).round(1)
    at, d, _ = kmeans.Groups(centres).nearest(x)
    want, dist = kmeans._nearest(x, centres)
    assert np.array_equal(at, want) and np.array_equal(d, dist)
