import math
import os
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixture import ascii_lower, corpus, frame, words

from corvid.llm import licenses, lm, quality, toxicity


def labels_for(spark, rows, fn):
    got = {}
    for i, t, *_ in rows:
        if i is not None:
            got[i] = fn(t or "")
    return spark.createDataFrame([(i, q, x, "noise") for i, (q, x) in got.items()] + [(None, 0, 1, "noise"), (5000, None, None, "")],
                                 "doc_id bigint, quality int, toxic int, text string")


# ---------------------------------------------------------------------------- LM


def test_lm_base_is_exact_and_counts_come_back(spark):
    rows = corpus()
    got = lm.score(frame(spark, rows), head=50).collect()  # most words take the join
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    toks = lambda t: [*words(ascii_lower(t or "")), None]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    c = Counter(x for i, t, *_ in rows if not held(i) for x in toks(t))
    total, types = sum(c.values()), len(c)
    scale = total + 0.5 * (types + 1)
    want = Counter((i, held(i), len(toks(t)), sum(c[x] > 0 for x in toks(t)), total,
                    round(sum(math.log10((c[x] + 0.5) / scale) for x in toks(t)), 6)) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_lm_filter_reads_quantised_counts():
    rng = np.random.default_rng(0)
    h = np.unique(rng.integers(0, 2**63, 20000, dtype=np.uint64) * np.uint64(2))
    c = np.minimum(rng.pareto(0.8, len(h)) + 1, 1e7).astype(np.int64)
    seg = (h >> np.uint64(62)).astype(int)
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    parts = [lm.build_segment((h[seg == s], c[seg == s]), none, 1 << 20)[0] for s in range(4)]
    m = lm.Model(parts, np.ones(4, np.int64), 1, 1, 1, *none)
    back = m.counts(h)
    exact = lm.level_counts()[lm.quantised(c)]
    assert (back >= exact).all() and (back == exact).mean() > 0.95
    assert (np.abs(exact - c) <= 0.25 * c + 0.5).all()
    assert (m.counts(h + np.uint64(1)) > 0).mean() < 0.05


def test_lm_segment_is_bounded():
    h = np.arange(1, 50001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    c = np.where(np.arange(50000) % 50 == 0, 40, 1)
    raw, least = lm.build_segment(none, (h, c), 16384)
    assert len(raw) <= 16384 and 1 < least <= 40
    m = lm.Model([raw, raw], np.full(2, least), 1, 1, 1, *none)
    back = m.counts(h)
    assert (back[c == 40] >= 30).all() and not m.outside(h[c == 40], back[c == 40]).any()
    assert m.outside(h[c == 1], back[c == 1]).mean() > 0.95


def test_lm_pairs_beyond_the_filter_are_joined(spark):
    rows = corpus()
    small = 1 << 13
    some = lm.train(frame(spark, [r for r in rows if r[1] is not None]).select("text"), 64, small)
    assert some.filter("pairs IS NOT NULL").count() > 10  # segments that leave pairs out
    wide = {(r["doc_id"], r["n_tokens"]): r for r in lm.score(frame(spark, rows)).collect()}
    tight = lm.score(frame(spark, rows), filter_bytes=small).collect()
    assert len(tight) == len(rows)
    for r in tight:
        other = wide[r["doc_id"], r["n_tokens"]]
        assert abs(r["score"] - other["score"]) <= 0.002 * abs(other["score"])  # false positives differ
        assert abs(r["base_score"] - other["base_score"]) < 1e-6


def test_lm_words_beyond_the_filter_are_joined(spark):
    from pyspark.sql import functions as F

    rows = corpus() + [(3000 + 5 * i, f"rare{i} odd{i} rare{i} w1 w2", "en", "s") for i in range(300)]
    docs = frame(spark, rows + [(3000, "rare0 odd0 rare0 w1 w2", "en", "s")])  # equal rows
    small = 1 << 11  # 32 bytes a segment: its words alone don't fit
    some = lm.train(docs.filter("text IS NOT NULL").select("text"), 64, small)
    assert some.filter("word_least > 1").count() > 10
    assert some.agg(F.max(F.length("bits"))).first()[0] <= small // 64
    # The scores by plain counts, quantised as a filter without false positives reads them.
    toks = lambda t: [*words(ascii_lower(t or "")), None]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    train = [toks(t) for i, t, *_ in [*rows, (3000, "rare0 odd0 rare0 w1 w2")] if not held(i)]
    level = lambda c: float(lm.level_counts()[lm.quantised(np.array([c]))[0]]) if c else 0.0
    one = Counter(x for t in train for x in t)
    two = Counter(x for t in train for x in zip(["", *t], t))
    scale = sum(one.values()) + 0.5 * (len(one) + 1)

    def brute(t):
        out = 0.0
        for v, w in zip(["", *toks(t)], toks(t)):
            p1, cv = min((level(one[w]) + 0.5) / scale, 1.0), len(train) if v == "" else level(one[v])
            out += math.log10(0.3 * min(level(two[v, w]), cv) / cv + 0.7 * p1 if cv else p1)
        return out

    want = {(i, len(toks(t)), round(brute(t), 6)): brute(t) for i, t, *_ in rows}
    got = lm.score(docs, filter_bytes=small).collect()
    assert len(got) == len(rows) + 1
    near = [min(abs(r["score"] - x) / abs(x) for (i, n, _), x in want.items() if (i, n) == (r["doc_id"], r["n_tokens"])) for r in got]
    assert max(near) < 0.05 and np.mean(near) < 0.003  # false positives
    base = {(r["doc_id"], r["n_tokens"]): r["base_score"] for r in lm.score(docs).collect()}
    assert all(abs(r["base_score"] - base[r["doc_id"], r["n_tokens"]]) < 1e-6 for r in got)


def test_lm_pack_round_trip():
    h = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64))
    c = np.arange(1000)
    a, b = lm.unpack(lm.pack(h, c))
    assert (a == h).all() and (b == c).all()


def test_lm_without_training_rows(spark):
    from pyspark.sql import functions as F

    got = lm.score(frame(spark, [(1, "a b", "en", "s"), (2, None, "en", "s")]), train_rows=F.lit(False)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    assert lm.score(frame(spark, [])).count() == 0


# ----------------------------------------------------------------------- quality


def brute_stats(text):
    t = text or ""
    w = words(t)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_quality_stats_against_brute_force(spark):
    rows = corpus() + [(2000, "a\n\na b\n a\na\n\na b\n", "en", "s")]
    labels = labels_for(spark, rows, lambda t: (1, 0))
    got = quality.judge(frame(spark, rows), labels).collect()
    want = Counter((i, *brute_stats(t)) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                   for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_quality_rejects_anomalies_and_keeps_clean(spark):
    import random

    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(40, 200))), "en", "s") for i in range(300)]
    bad = [(9000 + i, " ".join(word() + "###" for _ in range(120)), "en", "s") for i in range(25)]
    labels = labels_for(spark, rows + bad, lambda t: (0 if "###" in t else 1, 0))
    docs = frame(spark, rows + bad)
    got = quality.judge(docs, labels).collect()
    assert not any(r["kept"] for r in got if r["doc_id"] and r["doc_id"] >= 9000)
    assert all(r["kept"] for r in got if not r["base_failed"] and (r["doc_id"] or 0) < 900)
    kept = quality.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if r["kept"])


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = quality.judge(frame(spark, corpus()), none).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.judge(frame(spark, []), none).count() == 0


def quality_rows(spark, n, special):
    """Statistics of ``n`` documents inside every limit, then the special ones (ids from n on)."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n + len(special)):
        x = dict.fromkeys(quality.FEATURES, 0.0)
        x.update(upper_rate=rng.uniform(0, 0.05), log_word_length=rng.normal(1.8, 0.05), log_words=rng.normal(5.6, 0.3))
        x.update(special[i - n] if i >= n else {})
        rows.append((i, 300, 1500, 0, 0, 0, *(float(x[c]) for c in quality.FEATURES)))
    return spark.createDataFrame(rows, f"doc_id bigint, {quality.STATS}, {quality._MORE}")


def test_quality_finds_a_violation_that_is_not_sampled(spark):
    from pyspark.sql import functions as F

    stats = quality_rows(spark, quality.TREES * quality.TREE_ROWS + 5000, [])
    h = F.xxhash64("doc_id", F.lit(quality.SEED))
    n = stats.orderBy(h.desc()).first()["doc_id"]  # the largest hash: in no tree's sample
    for c, x in {"symbol_rate": 0.8, "symbol_excess": 0.7}.items():
        stats = stats.withColumn(c, F.when(F.col("doc_id") == n, x).otherwise(F.col(c)))
    scored = quality.score(stats, quality.fit_forests(stats))
    labels = stats.select("doc_id", (F.col("doc_id") != n).cast("int").alias("quality"))
    cuts = quality.calibrate(scored, labels)
    rejected = scored.filter((F.col("anomaly") >= cuts["anomaly"]) | (F.col("oddness") >= cuts["oddness"]))
    assert [r["doc_id"] for r in rejected.collect()] == [n]


def test_quality_can_reject_inside_the_limits(spark):
    from pyspark.sql import functions as F

    inside = [{"dup_line_rate": 0.29, "upper_rate": 0.29, "repeat_rate": 0.49 - i / 1000} for i in range(10)]
    stats = quality_rows(spark, 2000, inside)
    scored = quality.score(stats, quality.fit_forests(stats))
    cuts = quality.calibrate(scored, stats.select("doc_id", (F.col("doc_id") < 2000).cast("int").alias("quality")))
    gone = [r["doc_id"] for r in scored.filter((F.col("anomaly") >= cuts["anomaly"]) | (F.col("oddness") >= cuts["oddness"])).collect()]
    assert set(range(2000, 2010)) <= set(gone) and len(gone) < 15


def test_isolation_depth():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(500, 2)), [[9.0, 9.0]]])
    trees = [np.array(quality.grow_tree(x[rng.choice(501, 256, replace=False)], rng, 8)) for _ in range(50)]
    a = quality.anomaly(trees, x, 256)
    assert a.argmax() == 500 and a[500] > 0.6 and np.median(a) < 0.5


def test_anomaly_against_a_plain_walk():
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=(300, 3)), np.zeros((40, 3)), np.full((1, 3), 9.0)])
    picks = [rng.choice(len(x), 64, replace=False) for _ in range(20)]
    trees = [np.array(quality.grow_tree(x[p], rng, 6)) for p in picks]

    def length(tree, row):
        at, depth = 0, 0
        while tree[at][0] >= 0:
            feature, cut, left, right, _ = tree[at]
            at, depth = int(left if row[int(feature)] <= cut else right), depth + 1
        n = tree[at][4]
        c = 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
        return depth + c

    c64 = 2 * (math.log(63) + 0.5772156649) - 2 * 63 / 64
    want = [2 ** (-sum(length(t, r) for t in trees) / 20 / c64) for r in x]
    assert np.allclose(quality.anomaly(trees, x, 64), want) and int(np.argmax(want)) == len(x) - 1
    for t, p in zip(trees, picks):  # the leaves' sizes are the rows that end there
        ends = Counter()
        for row in x[p]:
            at = 0
            while t[at][0] >= 0:
                at = int(t[at][2] if row[int(t[at][0])] <= t[at][1] else t[at][3])
            ends[at] += 1
        assert all(ends[i] == node[4] for i, node in enumerate(t) if node[0] < 0)


# ---------------------------------------------------------------------- toxicity


def test_toxicity_learns_held_out(spark):
    import random

    rng = random.Random(2)
    rows = []
    for i in range(700):
        t = [f"w{rng.randrange(300)}" for _ in range(60)]
        if i % 6 == 0:
            t[rng.randrange(60)] = rng.choice(["Nasty,", "vile", "you rotten"])
        rows.append((i, " ".join(t), "en", "s"))
    rows += [(9001, None, None, None), (9002, "", "en", "s"), (None, "vile", "en", "s"), (3, rows[3][1], "en", "s")]
    labels = labels_for(spark, rows, lambda t: (1, int(any(x in t for x in ("Nasty", "vile", "rotten")))))
    got = toxicity.score(frame(spark, rows), labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in got if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_toxicity_bound_and_no_labels(spark):
    rows = corpus()
    labels = labels_for(spark, rows, lambda t: (1, int("w1 " in t)))
    n = toxicity.training_rows(frame(spark, rows), labels, "doc_id", "text", "doc_id", "toxic", None, 10)
    assert n.select("order").distinct().count() <= 10
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r["predicted"] for r in toxicity.score(frame(spark, rows), none).collect()} == {0}
    assert toxicity.score(frame(spark, []), none).count() == 0


# ---------------------------------------------------------------------- licences


@pytest.mark.parametrize("text,names,left", [
    ("Foo.\nReleased under the MIT License.", "MIT", ""),
    ("licensed UNDER the\n * apache   license version 2.0 ok", "Apache-2.0", ""),
    ("All rights reserved. Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", "reserved"),
    ("Licensed under CC BY-NC 4.", "", ""),
    ("x" * 50, "", ""),
    (" ".join(licenses.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-warranty")), "MIT", ""),
    (" ".join(licenses.SENTENCES[k] for k in ("mit-notice", "mit-grant", "mit-warranty")), "", "mit-notice,mit-grant,mit-warranty"),
    (" . ".join(licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary")), "BSD-2-Clause", ""),
    (" . ".join(licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")), "BSD-3-Clause", ""),
    ("Released under the MIT License. Released under the MIT License.", "MIT", ""),
    ("// SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0-or-later", ""),
    (" ".join(licenses.SENTENCES[k] for k in ("isc-grant", "isc-warranty")), "ISC", ""),
    (" ".join(licenses.SENTENCES[k] for k in ("0bsd-grant", "isc-warranty")), "0BSD", ""),
    (" ".join(licenses.SENTENCES[k] for k in ("lgpl-free", "lgpl-v21", "gpl-warranty")), "LGPL-2.1-or-later", ""),
    (" ".join(licenses.SENTENCES[k] for k in ("agpl-free", "gpl-v3")), "AGPL-3.0-or-later", ""),
])
def test_license_rules(spark, text, names, left):
    got = licenses.scan(frame(spark, [(1, text, "en", "s")])).first()
    assert (got["licenses"], got["unmatched"]) == (names, left)


def test_license_sentences_that_overlap_or_are_short():
    def ids(text, **table):
        raw = np.frombuffer(text.encode(), np.uint8)
        return licenses.recognise(raw, np.array([0, len(raw)]), table)[0]

    # The longer wins although it begins later; of equal lengths the earlier.
    assert ids("x y z w q r s", a="x y z", b="y z w q r s") == [(1, "b")]
    assert ids("x y z w q", a="x y z", b="z w q") == [(0, "a")]
    # One and two words, at the very end of a text too.
    assert ids("say mit licence", a="mit licence", b="say") == [(0, "b"), (1, "a")]
    assert ids("", a="mit") == [] and ids("mit", a="") == []
    two = np.frombuffer(b"mitlicence", np.uint8)
    assert licenses.recognise(two, np.array([0, 3, 10]), {"a": "mit licence", "b": "licence"}) == [[], [(0, "b")]]
    # Every name in the rules has its sentences, and each sentence is found as itself.
    assert {i for _, seq in licenses.RULES for i in seq} <= set(licenses.SENTENCES)
    for ident, sentence in licenses.SENTENCES.items():
        assert [k for _, k in ids(f"so {sentence} .", **licenses.SENTENCES)] == [ident]


def test_license_scan_against_brute_force(spark):
    rows = corpus()
    sent = list(licenses.SENTENCES.values())
    rows = [(i, t if t is None or k % 4 else t + "\n" + sent[k % len(sent)] + ".", *r) for k, (i, t, *r) in enumerate(rows)]
    known = {k: licenses.normalised(v) for k, v in licenses.SENTENCES.items()}

    def brute(t):
        w = licenses.normalised(ascii_lower(t or ""))
        hits = sorted((-len(s), i, k) for k, s in known.items() for i in range(len(w)) if w[i:i + len(s)] == s)
        free, out = set(range(len(w))), []
        for n, i, k in hits:
            if free >= set(range(i, i - n)):
                free -= set(range(i, i - n))
                out.append((i, k))
        return ",".join(k for _, k in sorted(out))

    got = licenses.scan(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["sentence_ids"]) for r in got) == Counter((i, brute(t)) for i, t, *_ in rows)
    assert licenses.scan(frame(spark, [])).count() == 0


def test_lm_scores_do_not_depend_on_shuffle_partitions(spark):
    """The filter's segments follow the texts alone."""
    rows = [r for r in corpus(n=60) if r[0] not in (None, 1004)]
    old, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("4", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out = lm.score(frame(spark, rows, 3 if n == "4" else 7), filter_bytes=1 << 14).collect()
            got.append({r["doc_id"]: (r["n_known"], round(r["score"], 7), round(r["base_score"], 7)) for r in out})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1] and len(got[0]) == len(rows)


def test_lm_segments_grow_with_the_texts(spark):
    small = spark.range(10).select(F.lit("x").alias("text"))
    assert lm.segment_count(small) == lm.LEAST_SEGMENTS and lm.segment_count(small.limit(0)) == lm.LEAST_SEGMENTS
    large = spark.range(200 * lm.SEGMENT_ROWS).select(F.lit("y").alias("text"))
    assert lm.segment_count(large) == 256 and lm.segment_count(large, 1 << 13) == 128


def test_toxicity_rows_are_bounded_and_fitted_as_a_plain_loop(spark):
    """Rows of one id count against the bound; equal rows train once; the fit is a plain
    per-coordinate loop."""
    tx = toxicity
    learn = [i for i in range(400) if zlib_mod(i) != 0]
    rows = [(i, f"good text {i % 7} bad" if i % 3 else f"awful nasty {i % 5}", "en", "s") for i in learn]
    hot = learn[3]
    rows += [(hot, f"many rows {k % 50}", "en", "s") for k in range(600)]   # a third of the table, 50 texts
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in learn], "doc_id bigint, quality int, toxic int")
    args = (frame(spark, rows), labels, "doc_id", "text", "doc_id", "toxic", None)
    few = tx.training_rows(*args, 10).collect()
    assert len(few) == 10 and len({(r["order"], tuple(r["places"])) for r in few}) == 10
    every = tx.training_rows(*args, 20_000).collect()
    assert len(every) == len(learn) + 50
    every.sort(key=lambda r: (r["order"], len(r["places"])))
    data, y = [np.array(r["places"], np.int64) for r in every], [r["label"] for r in every]
    z, n = {}, {}

    def weight(i):
        zi, l1 = z.get(i, 0.0), 0.0 if i == 1 << tx.BITS else tx.L1
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((tx.BETA + math.sqrt(n[i])) / tx.ALPHA + tx.L2)

    for _ in range(2):
        for x, t in zip(data, y):
            place = [*x.tolist(), 1 << tx.BITS]
            w = {i: weight(i) for i in place}
            g = (1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()))))) - t) * (tx.POSITIVE if t else 1.0)
            for i in place:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / tx.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    got = tx.fit_ftrl(data, np.array(y), 2)
    assert max(abs(got[i] - weight(i)) for i in z) < 1e-9


def zlib_mod(i):
    return zlib.crc32(str(i).encode()) % 5
