from corvid.plans.kmeans import assign_nearest, kmeans
from corvid.sources.text import read_centroids, read_vectors


def test_two_rounds_from_files_against_a_loop(spark, tmp_path):
    import math
    import random

    rng = random.Random(4)
    points = [[round(rng.uniform(0, 10), 3) for _ in range(3)] for _ in range(100)]
    centres = [list(map(float, p)) for p in points[:10]]
    lines = lambda rows: "".join(" ".join(map(str, r)) + "\n" for r in rows)
    for name, rows in (("p0", points[:50]), ("p1", points[50:]), ("c0", centres)):
        (tmp_path / name).write_text(lines(rows))
    pts = read_vectors(spark, [str(tmp_path / "p0"), str(tmp_path / "p1")], 3)
    cen = read_centroids(spark, str(tmp_path / "c0"), 3)
    assert [r.cid for r in cen.orderBy("cid").collect()] == list(range(10))
    res = kmeans(pts, cen, 2)
    want = dict(enumerate(centres))
    for _ in range(2):
        mine = {}
        for p in points:
            mine.setdefault(min(want, key=lambda c: (math.dist(p, want[c]), c)), []).append(p)
        want = {c: [sum(x) / len(g) for x in zip(*g)] for c, g in mine.items()}
    got = {r.cid: r.center for r in res.centroids.collect()}
    assert got.keys() == want.keys()
    assert max(abs(a - b) for c in got for a, b in zip(got[c], want[c])) < 1e-12
    assert len(res.errors) == 2 and res.errors[1] < res.errors[0]


def test_empty_clusters_vanish_and_ties_go_to_lowest_id(spark):
    pts = spark.createDataFrame([([0.0],), ([1.0],), ([10.0],)], "features array<double>")
    a = assign_nearest(pts, [(0, [0.5]), (1, [0.5]), (2, [100.0])]).collect()
    assert [r.cid for r in a] == [0, 0, 0]
    cen = spark.createDataFrame([(0, [0.0], 0), (1, [50.0], 0), (2, [10.0], 0)], "cid int, center array<double>, n bigint")
    res = kmeans(pts, cen, 1)
    got = {r.cid: r.center for r in res.centroids.collect()}
    assert got == {0: [0.5], 2: [10.0]}


def test_assignment_against_a_loop(spark):
    import math

    from corvid.sources.generate import generate_points

    pts = generate_points(spark, 500, 4, 2, seed=5)
    centres = [(j, [float(j), 10.0 - j, 2.5, float(j % 3)]) for j in range(6)]
    for r in assign_nearest(pts, centres).collect():
        d = [(math.dist(r.features, c), j) for j, c in centres]
        assert (r.cid, round(r.dist, 9)) == (min(d)[1], round(min(d)[0], 9))


def test_rounds_against_a_loop(spark):
    import math
    import random

    rng = random.Random(4)
    x = [[rng.random(), rng.random()] for _ in range(200)]
    want = [(i, x[i]) for i in range(5)]
    for _ in range(4):
        near = [min((math.dist(p, c), i) for i, c in want)[1] for p in x]
        want = [(i, [sum(p[k] for p, n in zip(x, near) if n == i) / near.count(i) for k in (0, 1)])
                for i, _ in want if i in near]
    cen = spark.createDataFrame([(i, x[i], 0) for i in range(5)], "cid int, center array<double>, n bigint")
    got = kmeans(spark.createDataFrame([(p,) for p in x], "features array<double>").repartition(3), cen, 4)
    for (i, c), r in zip(want, got.centroids.orderBy("cid").collect()):
        assert r.cid == i and math.dist(r.center, c) < 1e-9
    assert len(got.errors) == 4


def test_points_of_another_width_fail_and_nan_has_no_centre(spark):
    import math

    import pytest

    bad = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "features array<double>")
    with pytest.raises(Exception, match="without 2 coordinates"):
        assign_nearest(bad, [(0, [0.0, 0.0])]).collect()
    nan = spark.createDataFrame([([float("nan")],)], "features array<double>")
    r = assign_nearest(nan, [(3, [1.0])]).first()
    assert r.cid == -1 and math.isnan(r.dist)
