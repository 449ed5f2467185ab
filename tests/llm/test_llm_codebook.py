import hashlib
import math
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from corvid.llm import codebook


def table(rows, dim):
    return [(i, v, "x", 1, 2, [3]) for i, v in rows], "vec_id bigint, embedding array<float>, cluster string, distance int, codes int, rest array<int>"


def brute(rows, dim, k, rounds, scale=256):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, tuple(math.floor(scale * float(np.float32(x))) for x in v)))
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cent = [list(v) for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        got = [near(v)[1] for _, v in kept]
        for j in range(len(cent)):
            mine = [v for (_, v), g in zip(kept, got) if g == j]
            if mine:
                cent[j] = [sum(c) // len(mine) for c in zip(*mine)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in out:
        inertia[c] = inertia.get(c, 0) + d
    return sorted((str(i), c, d, inertia[c], sum(inertia.values())) for i, c, d in out), cent


def vectors(n=300, dim=8, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.1, 0.5, rng.uniform(-2, 2)]) for _ in range(dim)]) for i in range(n)]
    rows += [(i + 1000, rows[7][1]) for i in range(n // 2)]          # a third of the rows is one vector
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (2001, None), (2002, []), (2003, [0.5] * (dim - 1)),
             (2004, [0.5] * (dim - 1) + [None]), (2005, [0.5] * (dim - 1) + [float("nan")]), (2006, [0.5] * (dim - 1) + [float("inf")]),
             (2007, [-0.001] * dim), (2008, [-0.0] * dim)]
    return rows


@pytest.mark.parametrize("width,entries", [(None, 1 << 17), (1, 1 << 17), (2, 1 << 17), (3, 1 << 17), (8, 1 << 17), (2, 40), (1, 5), (4, 0)])
def test_clusters_against_plain_loops(spark, width, entries):
    """Every block width, and dictionaries that hold all, some or no subvectors."""
    rows = vectors()
    data, schema = table(rows, 8)
    got = codebook.cluster(spark.createDataFrame(data, schema).repartition(5), dim=8, k=6, rounds=3, width=width, entries=entries)
    want, cent = brute(rows, 8, 6, 3)
    assert sorted((str(r[0]), *r[1:]) for r in got.rows.collect()) == want
    assert got.centroids.tolist() == cent and got.entries <= entries
    hashes = codebook.centroid_table(spark, got).collect()
    assert [h["centroid_sha256"] for h in hashes] == [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]


def test_few_vectors_empty_table_and_large_components(spark):
    schema = "vec_id bigint, embedding array<double>"
    got = codebook.cluster(spark.createDataFrame([(1, [0.5, 1.0]), (2, [3.0, 4.0])], schema), dim=2, k=5, rounds=2)
    assert sorted(r["distance"] for r in got.rows.collect()) == [0, 0] and len(got.centroids) == 2
    none = codebook.cluster(spark.createDataFrame([], schema), dim=2, k=5)
    assert none.rows.collect() == [] and none.rows.columns == got.rows.columns
    assert codebook.centroid_table(spark, none).collect() == []
    with pytest.raises(Exception, match="component"):
        codebook.cluster(spark.createDataFrame([(1, [1e30, 0.0])], schema), dim=2, k=5)


def test_width_follows_the_data(spark):
    """Few distinct subvectors: wide blocks; all distinct: single components."""
    rng = random.Random(1)
    few = spark.createDataFrame([(i, [rng.choice([0.0, 1.0]) for _ in range(8)]) for i in range(400)], "vec_id bigint, embedding array<double>")
    many = spark.createDataFrame([(i, [rng.random() for _ in range(8)]) for i in range(400)], "vec_id bigint, embedding array<double>")
    assert codebook.cluster(few, dim=8, k=3, rounds=1).width == 4
    assert codebook.cluster(many, dim=8, k=3, rounds=1, scale=1 << 16).width == 1
