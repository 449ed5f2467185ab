import pandas as pd
from pyspark.sql import functions as F

from corvid.functions.combiners import array_plus, grouped_udf, plus
from corvid.operators import keyed
from corvid.plans.collectives import graph_degrees, push_pull_sync, word_average

W = 3  # simulated workers


def _arrays(spark, ids_of):
    rows = [(w, i, [1.0, 0.0, float(w)]) for w in range(W) for i in ids_of(w)]
    return spark.createDataFrame(rows, "owner int, id int, arr array<double>")


def test_word_average_every_worker_same_words(spark):
    words = ["apple", "banana", "cherry", "grape", "kiwi", "mango", "peach"]
    rows = [(w, v + 1, 1) for _ in range(W) for v, w in enumerate(words)]
    df = spark.createDataFrame(rows, "word string, val int, cnt int")
    out = {r.word: r.average for r in word_average(df).collect()}
    assert out == {w: i + 1 for i, w in enumerate(words)}


def test_reduce_and_allreduce_sum_arrays(spark):
    t = _arrays(spark, lambda w: range(4))
    red = keyed.reduce(t, "id", array_plus("arr", 3)).collect()
    assert all(r.arr[0] == W and r.arr[2] == sum(range(W)) and r.owner == 0 for r in red)
    assert keyed.allreduce(t, "id", array_plus("arr", 3)).count() == 4


def test_allgather_disjoint_ids_and_gather_bag(spark):
    t = _arrays(spark, lambda w: [w * 10 + i for i in range(4)])
    assert keyed.allgather(t, "id", array_plus("arr", 3)).count() == W * 4
    assert keyed.gather([t, t]).count() == 2 * W * 4


def test_array_plus_rejects_other_lengths(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0])], "id int, arr array<double>")
    import pytest
    with pytest.raises(Exception):
        keyed.combine_by_id(df, "id", array_plus("arr", 2)).collect()


def test_push_then_pull_adds(spark):
    local = _arrays(spark, lambda w: range(2)).select("owner", "id", F.col("arr")[0].alias("v"))
    global_ = spark.createDataFrame([(0, 0.0)], "id int, v double")
    new_global, new_local = push_pull_sync(local, global_, "id", plus("v"))
    assert {r.id: r.v for r in new_global.collect()} == {0: W, 1: W}
    # pull adds the global value to the local one (W + 1), it does not replace it
    assert all(r.v == W + 1 for r in new_local.collect())
    assert new_local.count() == W * 2


def test_pull_missing_id_fails_or_keeps(spark):
    import pytest
    local = spark.createDataFrame([(5, 1)], "id int, v int")
    global_ = spark.createDataFrame([(0, 1)], "id int, v int")
    with pytest.raises(Exception):
        keyed.pull(local, global_, "id", plus("v")).collect()
    assert keyed.pull(local, global_, "id", plus("v"), on_missing="keep").first().v == 1


def test_lookup_remove_regroup_rotate(spark):
    t = spark.createDataFrame([(1, 10), (2, 20), (-3, 30)], "id int, v int")
    keys = spark.createDataFrame([(1,), (4,)], "id int")
    assert {r.id: r.v for r in keyed.get_val(t, keys, "id", {"v": -1}).collect()} == {1: 10, 4: -1}
    assert sorted(r.id for r in keyed.remove_val(t, keys, "id").collect()) == [-3, 2]
    rg = {r.id: r.owner for r in keyed.regroup(t, "id", plus("v"), 2).collect()}
    assert rg == {1: 1, 2: 0, -3: 1}
    owners = spark.createDataFrame([(0,), (1,), (2,)], "owner int")
    assert [r.owner for r in keyed.rotate_owner(owners, 3).collect()] == [1, 2, 0]
    assert [r.owner for r in keyed.rotate_owner(owners, 3, rotate_map={0: 2}).collect()] == [2, 1, 2]
    assert keyed.reject_nulls(spark.createDataFrame([(1, None), (2, 3)], "id int, v int"), ["id", "v"]).count() == 1


def test_user_combiner_runs_in_two_bounded_phases(spark):
    def longest(s: pd.Series) -> int:
        return int(s.max())

    df = spark.range(0, 1000, numPartitions=4).select((F.col("id") % 3).alias("k"), F.col("id").cast("int").alias("v"))
    out = {r.k: r.v for r in keyed.combine_by_id(df, "k", grouped_udf(longest, "v", "int")).collect()}
    assert out == {0: 999, 1: 997, 2: 998}


def test_graph_degrees(spark):
    e = spark.createDataFrame([(0, 1), (0, 2), (1, 2), (3, 2)], "src int, dst int")
    got = {r.vertex: (r.in_degree, r.out_degree) for r in graph_degrees(e).collect()}
    assert got == {0: (None, 2), 1: (1, 1), 2: (3, None), 3: (None, 1)}


def test_checked_broadcast_and_broadcast_pull(spark):
    small = spark.createDataFrame([(1, 5)], "id int, v int")
    local = spark.createDataFrame([(1, 1)], "id int, v int")
    assert keyed.pull(local, small, "id", plus("v"), use_bcast=True).first().v == 6
    big = spark.range(1000).select(F.col("id").cast("int").alias("id"), F.lit(1).alias("v"))
    assert keyed.checked_broadcast(big, 100) is big


def test_partition_functions_columns_and_pandas(spark):
    """A finish function as column expressions or as a mapInPandas batch function."""
    df = spark.createDataFrame([("a", 3, 1), ("a", 4, 1), ("b", 5, 1)], "word string, val int, cnt int")
    cols = keyed.regroup_aggregate(df, "word", plus("val", "cnt"), {"mean": F.col("val") / F.col("cnt")}, n=2)
    assert {r.word: r.mean for r in cols.collect()} == {"a": 3.5, "b": 5.0}

    def halve(batches):
        for pdf in batches:
            pdf["val"] = pdf["val"] // 2
            yield pdf

    out = keyed.aggregate(df, "word", plus("val", "cnt"),
                          lambda t: t.mapInPandas(halve, schema=t.schema))
    assert {r.word: r.val for r in out.collect()} == {"a": 3, "b": 2}


def test_user_combiner_runs_once_per_key_and_never_on_a_whole_hot_key(spark):
    """a key whose rows meet nowhere but at the end costs one call, not one per partition;
    a hot key is combined a bounded run at a time; null, NaN and zero keys, other result types."""
    calls = spark.sparkContext.accumulator(0)

    def total(v: pd.Series) -> int:
        calls.add(1)
        if len(v) > (1 << 19) + 20_000:
            raise ValueError(f"{len(v)} values of one key at once")
        return int(v.sum())

    apart = spark.range(0, 4000, numPartitions=4).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    got = {r.k: r.v for r in keyed.combine_by_id(apart, "k", grouped_udf(total, "v", "bigint")).collect()}
    assert got == {k: 4 * k + 6000 for k in range(1000)} and calls.value <= 1100
    hot = spark.range(0, 1_300_000, numPartitions=1).select(F.when(F.col("id") > 2, F.lit("a")).alias("k"), F.lit(1).cast("bigint").alias("v"))
    assert {r.k: r.v for r in keyed.combine_by_id(hot, "k", grouped_udf(total, "v", "bigint")).collect()} == {"a": 1_299_997, None: 3}
    rows = [(x, d, v) for x in (0.0, -0.0, float("nan"), None) for d in ("x", None) for v in (1, 2)]
    odd = spark.createDataFrame(rows, "k double, d string, v int").repartition(3)
    both = keyed.combine_by_id(odd, ["k", "d"], grouped_udf(lambda v: float(v.sum()), "v", "double")).collect()
    assert sorted((str(abs(r.k) if r.k is not None else None), str(r.d), r.v) for r in both) == sorted(
        (k, d, s) for k, s in (("0.0", 6.0), ("nan", 3.0), ("None", 3.0)) for d in ("x", "None"))
    nested = spark.createDataFrame([((1,), 2), ((1,), 3)], "k struct<a: int>, v int")
    assert [r.v for r in keyed.combine_by_id(nested, "k", grouped_udf(total, "v", "int")).collect()] == [5]
