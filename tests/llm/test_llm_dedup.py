import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import xxhash

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixture import ascii_lower, components, corpus, frame, words

from corvid.llm import simhash, substring
from corvid.llm.components import connected


def brute_fp(text):
    w = words(ascii_lower(text or ""))
    if not w:
        return 0
    k = min(4, len(w))
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_against_all_pairs(spark):
    rows = corpus()
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    fps = {(i, t): brute_fp(t) for i, t, *_ in rows}
    assert {(r["doc_id"], r["fp"] % 2**64) for r in got} == {(i, f) for (i, _), f in fps.items()}
    nodes = sorted(set(fps.values()))
    label = components(nodes, [(a, b) for a in nodes for b in nodes if a < b and bin(a ^ b).count("1") <= 4])
    low = {}
    for (i, _), f in fps.items():
        if i is not None:
            low[label[f]] = min(low.get(label[f], i), i)
    for r in got:
        assert r["component_id"] == low.get(label[r["fp"] % 2**64])


def test_links_reach_every_near_fingerprint(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(300)}
    centre = rng.getrandbits(64)
    for _ in range(200):  # a crowd that meets in every block choice
        x = centre
        for b in rng.sample(range(64), rng.randint(0, 5)):
            x ^= 1 << b
        fps.add(x)
    chain = rng.getrandbits(64)
    for _ in range(30):  # far ends linked through their neighbours only
        for b in rng.sample(range(64), 4):
            chain ^= 1 << b
        fps.add(chain)
    nodes = sorted(fps)
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in nodes], "fp bigint")
    found = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(df).collect()]
    assert all(bin(a ^ b).count("1") <= 4 for a, b in found)
    real = [(a, b) for a in nodes for b in nodes if a < b and bin(a ^ b).count("1") <= 4]
    assert components(nodes, found) == components(nodes, real)
    star = {r["a"] % 2**64: r["b"] % 2**64 for r in connected(simhash.links(df)).collect()}
    want = components(nodes, real)
    groups = {}
    for n in nodes:
        groups.setdefault(star.get(n, n), set()).add(n)
    assert {frozenset(g) for g in groups.values()} == {frozenset(m for m in nodes if want[m] == w) for w in set(want.values())}


def test_crowded_meetings_are_split_and_lose_no_link(spark):
    rng = random.Random(8)
    open_bits = range(12, 38)
    base = rng.getrandbits(64)
    fps = set()
    while len(fps) < 700:  # all agree on 38 bits; some of them near, most not
        x = base
        for b in open_bits:
            x ^= rng.getrandbits(1) << b
        fps.add(x)
        for b in rng.sample(open_bits, 3):
            x ^= 1 << b
        if rng.random() < 0.3:
            fps.add(x)
    for a in range(64):  # near copies of one fingerprint, more than a crowd
        for b in range(a):
            if rng.random() < 0.1:
                fps.add(base ^ 1 << a ^ 1 << b)
    nodes = sorted(fps)
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in nodes], "fp bigint")
    plain = [tuple(r) for r in simhash.meetings(df).groupBy("choice", "value").count().collect()]
    split = simhash.meetings(df, crowd=100).groupBy("choice", "value").count().collect()
    assert max(n for *_, n in plain) > 500 and max(r["count"] for r in split) <= 100
    found = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(df, crowd=100).collect()]
    assert all(bin(a ^ b).count("1") <= 4 for a, b in found)
    real = [(a, b) for a in nodes for b in nodes if a < b and bin(a ^ b).count("1") <= 4]
    assert components(nodes, found) == components(nodes, real)


def test_survivors_of_rows_that_differ_elsewhere(spark):
    rows = [(1, "the same text for all of them", f"k{i}") for i in range(6)]
    told = {simhash.survivors(spark.createDataFrame(r, "doc_id int, text string, `a.b` string").repartition(n)).first()["a.b"]
            for n, r in ((1, rows), (3, rows[::-1]), (6, rows[3:] + rows[:3]))}
    assert len(told) == 1


def test_pivots_never_lose_a_near_pair():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)) ^ np.uint64(7)
    table = simhash.distance_table(np.concatenate([a, b]), simhash.pivots())
    assert len(simhash._survivors(np.arange(500), np.arange(500) + 500, table, 4)) == 500


def test_block_choices_cover_any_four_bits():
    for n in (10, 10**5, 10**8):
        masks = simhash.block_choices(n)
        for seed in range(50):
            diff = sum(1 << b for b in random.Random(seed).sample(range(64), 4))
            assert any(diff & m == 0 for m in masks)


def test_survivors_one_row_each(spark):
    rows = corpus()
    docs = frame(spark, rows)
    kept = simhash.survivors(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    nodes = sorted({brute_fp(t) for _, t, *_ in rows})
    label = components(nodes, [(a, b) for a in nodes for b in nodes if a < b and bin(a ^ b).count("1") <= 4])
    first = {}
    for i, t, *_ in rows:
        g = label[brute_fp(t)]
        first[g] = min(first.get(g, (True, 0)), (i is None, i or 0))
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == Counter(first.values())


def brute_cut(rows, window):
    of = {}
    docs = [(i, words(t)) for i, t, *_ in rows]
    for i, w in docs:
        if i is not None:
            for p in range(len(w) - window + 1):
                k = tuple(w[p:p + window])
                of[k] = min(of.get(k, i), i)
    out = []
    for i, w in docs:
        gone = set()
        if i is not None:
            for p in range(len(w) - window + 1):
                if of[tuple(w[p:p + window])] < i:
                    gone.update(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def check_cut(spark, rows, window):
    got = substring.dedup(frame(spark, rows), window=window).collect()
    assert Counter(tuple(r) for r in got) == brute_cut(rows, window)


def test_substring_dedup_brute_force(spark):
    rows = corpus()
    want = brute_cut(rows, 50)
    assert sum(k[2] > 0 for k in want) > 5
    check_cut(spark, rows, 50)


def test_substring_dedup_few_words_and_runs(spark):
    rng = random.Random(5)
    rows = []
    for i in range(40):
        w = []
        while len(w) < 150:
            w += [rng.choice("abc")] * rng.choice([1, 1, 2, 7, 60])
        if i > 5 and i % 2:
            j = rng.randrange(i)
            src = rows[j][1].split()
            at = rng.randrange(max(1, len(src) - 60))
            w[20:20] = src[at:at + 55]
        rows.append((i, " ".join(w), "en", "s"))
    check_cut(spark, rows, 50)


def test_interior_symbols_are_the_same_wherever_a_window_stands():
    rng = np.random.default_rng(1)
    for words_ in (3, 50, 5000):
        window = rng.integers(0, words_, 50).astype(np.uint64)
        seen = set()
        for _ in range(20):
            left, right = (rng.integers(0, words_, rng.integers(0, 40)).astype(np.uint64) for _ in range(2))
            h = substring.mix(np.concatenate([left, window, right]) + np.uint64(1))
            at = np.array([len(left)])
            symbols, p, q = substring.interior(h, at, at + 50)
            seen.add((tuple(symbols[p[0]:q[0]].tolist()), int(substring.window_keys(h, at)[0])))
        assert len(seen) == 1
        if words_ == 5000:
            assert len(seen.pop()[0]) >= 3


def test_repeated_rows_report_each_place_once(spark):
    from pyspark.sql import functions as F

    told = spark.range(400 * 31).select(F.lit(9).alias("doc_id"), F.lit(1).alias("row_hash"), (F.col("id") % 31).cast("int").alias("pos"))
    row = substring.cut_positions(told).first()
    assert sorted(row["cuts"]) == list(range(31))
    # A third of the table is one row, whose passage an earlier document has.
    text = " ".join(f"p{i}" for i in range(80))
    rows = [(1, text + " end", "en", "s")] + [(9, "own words " + text, "en", "s")] * 30 + [(100 + i, f"q{i} " * 60, "en", "s") for i in range(60)]
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in substring.dedup(frame(spark, rows)).collect()}
    assert (9, 82, 80) in got and (1, 81, 0) in got and len(got) == 62


def test_cut_documents_keeps_columns(spark):
    docs = frame(spark, corpus())
    out = substring.cut_documents(docs, size_col="n_chars")
    assert out.columns == docs.columns
    for r in out.collect():
        assert r["text"] is None or r["n_chars"] is None or len(r["text"]) == r["n_chars"]
        assert (r["key"], r["size"], r["h"]) == ("k", 2, 3)


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.survivors(docs).count() == 0
    assert substring.dedup(docs).count() == 0
