from pyspark.sql import functions as F

from corvid.operators import forest as fo
from corvid.plans.forest import example_rows, load_forest, predict, save_forest, train_forest
from corvid.sources.text import read_sparse_labeled


#: Two classes over the features 1..6; feature 2 tells them apart but for one row each way.
LINES = """1 1:1 2:1 3:1
1 2:1 4:1
1 2:1 3:1 5:1
1 1:1 2:1 6:1
1 3:1 5:1
0 1:1 3:1
0 4:1
0 1:1 4:1 6:1
0 2:1 4:1 6:1
0 3:1 6:1
"""


def test_forest_from_a_file_of_labelled_lines(spark, tmp_path):
    (tmp_path / "lines").write_text(LINES)
    lab, post = read_sparse_labeled(spark, str(tmp_path / "lines"))
    labels = {r.example: r.label for r in lab.collect()}
    held = [(r.feature, r.example) for r in post.collect()]
    assert sorted(labels.values()) == [0] * 5 + [1] * 5
    root = lab.select(F.lit(0).alias("tree"), F.lit(1).cast("bigint").alias("node"), "example", "label")
    got = {r.feature: (r.m, r.c, r.score) for r in fo.scores(fo.weighted_postings(post), root).collect()}
    g = lambda p: p * (1 - p)
    n, pos = len(labels), sum(labels.values())
    for f in {f for f, _ in held}:
        m, c = sum(x == f for x, _ in held), sum(labels[e] for x, e in held if x == f)
        score = -1e30 if m == n else m / n * g(c / m) + (n - m) / n * g((pos - c) / (n - m))
        assert got[f][:2] == (m, c) and abs(got[f][2] - score) < 1e-12
    model = train_forest(lab, post, num_trees=5, max_depth=3)
    best = min(got, key=lambda f: (got[f][2], f))
    assert {r.feature for r in model.nodes.filter("node = 1").collect()} == {best}
    acc = fo.accuracy(predict(model, lab, post), lab).first()
    assert acc.total == 10 and acc.hits >= 8
    save_forest(model, str(tmp_path / "forest"))
    again = load_forest(spark, str(tmp_path / "forest"))
    assert again.num_trees == 5 and fo.accuracy(predict(again, lab, post), lab).first().hits == acc.hits


def test_stop_rules_and_empty_side(spark):
    # Feature 5 is on every example: score -1e30, so the root is a leaf in reference mode.
    lab = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "example long, label int")
    post = spark.createDataFrame([(5, 0), (5, 1), (5, 2), (6, 1)], "feature int, example long")
    ref = train_forest(lab, post, num_trees=1, max_depth=3)
    assert ref.nodes.count() == 1 and ref.nodes.first().prediction == 1
    gini = train_forest(lab, post, num_trees=1, max_depth=3, mode="gini")
    assert gini.nodes.filter("node = 1").first().feature == 6


def test_majority_and_vote_tie_give_one(spark):
    preds = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 0), (1, 1)], "example long, prediction int")
    assert {r.example: r.prediction for r in fo.vote(preds).collect()} == {0: 1, 1: 0}


def test_random_draws_are_repeatable_and_batch_free(spark):
    """With few draws per node the trees differ; the hashed draw makes the forest the same
    for the same seed, whether trees grow all together or in ranges."""
    lab, post, _, _ = _small_data(spark)
    a = train_forest(lab, post, num_trees=4, max_depth=3, subset=2, seed=11)
    b = train_forest(lab, post, num_trees=4, max_depth=3, subset=2, seed=11, tree_batch=3)
    rows = lambda m: sorted(tuple(r) for r in m.nodes.collect())
    assert not a.identical and rows(a) == rows(b)
    roots = {r.tree: r.feature for r in a.nodes.filter("node = 1").collect()}
    assert len(roots) == 4
    acc = fo.accuracy(predict(a, lab, post), lab).first()
    assert acc.total == 60


def _small_data(spark, n=60, features=14, seed=3):
    import random
    rng = random.Random(seed)
    lab = [(i, int(rng.random() < 0.5)) for i in range(n)]
    post = [(f"f{f}", i) for i, y in lab for f in range(features) if rng.random() < (0.3 + 0.3 * y * (f % 3 == 0))]
    post += [("f1", 0), ("f1", 0), ("f2", 5)]
    return (spark.createDataFrame(lab, "example long, label int"), spark.createDataFrame(post, "feature string, example long"), dict(lab), post)


def _plain_forest(labels, post, trees, depth, subset, seed):
    """Trees by recursion, set postings, the same hashed draws; (tree, node) -> (feature, prediction)."""
    import hashlib
    has = {}
    for f, e in post:
        has.setdefault(f, set()).add(e)
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    out, widest = {}, 0

    def grow(t, node, ex, d):
        nonlocal widest
        n, pos = len(ex), sum(labels[e] for e in ex)
        leaf = (None, 0 if n - pos > pos else 1)
        if d == depth or pos in (0, n):
            out[t, node] = leaf
            return
        present = sorted((f for f in has if has[f] & ex), key=lambda f: (md5(f)[:2], f))
        taken = {min(int(int(md5(f"{seed}|{t}|{node}|{i}")[:13], 16) / 2.0 ** 52 * len(present)), len(present) - 1) for i in range(subset)}
        widest = max(widest, len(taken))

        def score(f):
            m, c = len(has[f] & ex), sum(labels[e] for e in has[f] & ex)
            g = lambda p: p * (1 - p)
            return fo.ABSENT if m == n else m / n * g(c / m) + (n - m) / n * g((pos - c) / (n - m))

        s, f = min((score(present[k]), present[k]) for k in taken)
        if s <= 0:
            out[t, node] = leaf
            return
        out[t, node] = (f, None)
        grow(t, 2 * node, ex & has[f], d + 1)
        grow(t, 2 * node + 1, ex - has[f], d + 1)

    for t in range(trees):
        grow(t, 1, set(labels), 0)
    return out, widest


def test_forest_equals_plain_recursion_and_draws_at_most_subset(spark):
    lab, post, labels, rows = _small_data(spark)
    want, widest = _plain_forest(labels, rows, 4, 3, 5, 9)
    model = train_forest(lab, post, num_trees=4, max_depth=3, subset=5, seed=9, duplicates="set")
    assert {(r.tree, r.node): (r.feature, r.prediction) for r in model.nodes.collect()} == want and widest <= 5
    fs = fo.feature_stats(fo.weighted_postings(post, "set"), lab.select(F.lit(0).alias("tree"), F.lit(1).cast("bigint").alias("node"), "example", "label"))
    sizes = spark.createDataFrame([(t, 1, fs.count()) for t in range(50)], "tree int, node bigint, F bigint")
    drawn = fo.draw(fs.drop("tree"), sizes, 5, 1).groupBy("tree").agg(F.count("feature").alias("n"), F.countDistinct("feature").alias("d")).collect()
    assert len(drawn) == 50 and all(r.n == r.d <= 5 for r in drawn) and len({r.n for r in drawn}) > 1
    everything = fo.present(fs).select("rank").collect()
    assert sorted(r["rank"] for r in everything) == list(range(fs.count()))


def test_draws_along_slots_equal_draws_of_counted_features(spark):
    """A level keeps one row per feature, not one per tree, node and feature; the draws and
    their counts are those of the numbered features. 72 slots take two words."""
    lab, post, _, _ = _small_data(spark, n=90)
    slots = [[0, 1], [None if i == 3 else 2 + i for i in range(70)]]
    at = F.array((F.col("example") % 2).cast("int"), (F.col("example") % 70).cast("int"))
    rows = example_rows(lab, post, "set").select("label", "feats", *fo.slot_words(at, slots))
    assert rows.columns == ["label", "feats", "w0", "w1"]
    seen = fo.seen_at(rows).persist()
    assert seen.count() == post.select("feature").distinct().count()
    slot = F.explode(F.array((F.col("example") % 2), F.when(F.col("example") % 70 != 3, 2 + F.col("example") % 70)))
    placed = lab.select(slot.alias("tree"), F.lit(1).cast("bigint").alias("node"), "example", "label").filter("tree is not null")
    fs = fo.feature_stats(fo.weighted_postings(post, "set"), placed)
    sizes = fs.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("F"))
    want = sorted(tuple(r) for r in fo.draw(fs, sizes, 4, 5).collect())
    nodes = spark.createDataFrame([(s, s, 1) for s in range(72)], "slot int, tree int, node bigint")
    drawn = fo.draw_at(seen, nodes, 4, 5, 72).persist()
    assert sorted(tuple(r) for r in fo.drawn_stats(rows, drawn, 72 * 4).collect()) == want and len({t for t, *_ in want}) > 62
    drawn.unpersist()
    seen.unpersist()


def test_prediction_walks_every_tree(spark):
    lab, post, labels, rows = _small_data(spark)
    model = train_forest(lab, post, num_trees=3, max_depth=4, subset=4, seed=2, duplicates="set")
    nodes = {(r.tree, r.node): r for r in model.nodes.collect()}
    has = {(f, e) for f, e in rows}
    extra = [*labels, 900]   # an example without any feature
    ex = spark.createDataFrame([(e,) for e in extra], "example long")

    def walk(t, e):
        n = 1
        while not nodes[t, n].is_leaf:
            n = 2 * n if (nodes[t, n].feature, e) in has else 2 * n + 1
        return nodes[t, n].prediction

    each = {(r.tree, r.example): r.prediction for r in predict(model, ex, post, per_tree=True).collect()}
    assert each == {(t, e): walk(t, e) for t in range(3) for e in extra}
    voted = {r.example: r.prediction for r in predict(model, ex, post).collect()}
    assert voted == {e: int(sum(each[t, e] for t in range(3)) * 2 >= 3) for e in extra}
