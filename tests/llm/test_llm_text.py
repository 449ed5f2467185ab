import hashlib
import math
import os
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixture import corpus, frame, words

from corvid.llm import chat, fingerprint, mixing, sentencepiece

# -------------------------------------------------------------------------- chat

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\l", "\\\\<s>", "<|image|> [/INST]</s>", "a\nb\n", "", None, "\x00\x000\x001", "<<s>>", "[[INST]"]


def chat_rows():
    rows = []
    for c in range(12):
        for t in range(c):
            rows.append((c, t, ["system", "user", "assistant"][t % 3], NASTY[(c + t) % len(NASTY)], "x", 9))
    rows += [(50, 0, None, "no role", "x", 9), (50, None, "assistant", "late", "x", 9), (50, 0, "assistant", "tie", "x", 9),
             (50, 0, "assistant", "tie", "x", 9), (None, 0, "user", "null id", "x", 9), (51, 0, "odd\nrole [INST]", "t", "x", 9)]
    return rows


def test_chat_round_trip(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(chat_rows(), "conv_id bigint, turn bigint, role string, text string, formatted string, rows int")
    out = chat.format_chat(df.repartition(4)).withColumn("back", chat.parse_chat(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    want = {}
    for c, t, role, text, *_ in chat_rows():
        want.setdefault(c, []).append((t is None, t, role or "", text or ""))
    got = out.collect()
    assert len(got) == len(want)
    for r in got:
        turns = sorted(want[r["conv_id"]], key=lambda x: (x[0], x[1] or 0, x[2], x[3]))
        assert [(b["role"], b["text"]) for b in r["back"]] == [x[2:] for x in turns]
        assert r["loss"] == "".join(x[3] for x in turns if x[2] == "assistant")
        assert r["n_turns"] == len(turns)
        assert len(r["loss_spans"]) == sum(x[2] == "assistant" for x in turns)


def test_chat_orders_ties_by_the_text_itself_and_folds_long_conversations(spark):
    from pyspark.sql import functions as F

    # Escaped, "<s>" begins with a backslash and would come after "=".
    tied = spark.createDataFrame([(1, 0, "user", t) for t in ("=", "<s>", "[INST]", "A", "\\")], "conv_id int, turn int, role string, text string")
    got = chat.format_chat(tied.repartition(3)).select(chat.parse_chat(F.col("formatted")).alias("b")).first()["b"]
    assert [t["text"] for t in got] == ["<s>", "=", "A", "[INST]", "\\"]
    # Spans are running sums: 30,000 turns of one conversation, each span holds its own text.
    n = 30_000
    many = spark.range(n).select(F.lit(5).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"),
                                 F.concat(F.lit("<s>"), F.col("id").cast("string")).alias("text"))
    row = chat.format_chat(many).first()
    at = [tuple(s) for s in row["loss_spans"]]
    assert len(at) == n and [row["formatted"][a:a + k] for a, k in (at[0], at[17], at[-1])] == ["\\ls>0", "\\ls>17", f"\\ls>{n - 1}"]


def test_chat_parts(spark):
    parts = [("text", "look <s> ", None, None), ("image", None, "a.png", 28 * 28 * 3 + 1), ("text", "and", None, None),
             ("audio", None, "b.wav", 100), ("document", None, "c.pdf", 2), ("video", None, "d", 5), ("image", None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (2, 0, "assistant", [])],
                               f"conv_id bigint, turn bigint, role string, content array<{chat.PART}>")
    got = {r["conv_id"]: r for r in chat.format_chat(df, parts="content").collect()}
    assert got[1]["formatted"] == ("<s>[INST] user\nlook \\l" + "s> <|image|>and<|audio|><|document|><|video|><|image|> [/INST]"
                                   "[INST] assistant\n [/INST]</s>")
    assert [tuple(a) for a in got[1]["attachments"]] == [("image", "a.png", 6), ("audio", "b.wav", 3), ("document", "c.pdf", 512),
                                                         ("video", "d", 0), ("image", None, 2)]
    assert got[2]["attachments"] == [] and [tuple(s) for s in got[2]["loss_spans"]] == [(20, 0)]
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.format_chat(empty).count() == 0


# ------------------------------------------------------------------------ mixing


def brute_targets(sizes, budget):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    full, out = set(), {}
    while True:
        free = [s for s in order if s not in full]
        left = budget - sum(3 * sizes[s] for s in full)
        out = {s: 3.0 * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if out[s] > 3 * sizes[s]}
        if not over:
            return out
        full |= over


def test_mix_targets_and_counts(spark):
    rows = [(i if i is None or i > 1000 else i + 20000, *r) for i, *r in corpus(n=330)] + [(8000 + i, "tiny words here", "en", f"z{i % 4}") for i in range(12)] + [(8100, "", "en", "empty source")]
    got = mixing.mix(frame(spark, rows), buckets=16).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(words(t))) for i, t, *_ in rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    target = brute_targets(sizes, sum(sizes.values()))
    assert any(math.isclose(target[s], 3 * sizes[s]) for s in sizes) and any(target[s] < sizes[s] for s in sizes if sizes[s])
    source = {i: s for i, _, _, s in rows if i not in (None, 1004)}
    most, taken = Counter(), Counter()
    for r in got:
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        if r["doc_id"] in source:
            s = source[r["doc_id"]]
            assert math.isclose(r["target"], target[s], abs_tol=1e-6) and r["source_size"] == sizes[s]
            taken[s] += r["taken"]
            most[s] = max(most[s], r["size"])
    for s in set(source.values()) - {"tiny", None, "s4"}:
        assert abs(taken[s] - target[s]) <= most[s] / 2 + 1e-6
    again = mixing.mix(frame(spark, rows, 2), buckets=7).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in got)


def test_mixed_documents_rows(spark):
    rows = corpus(n=100)
    docs = frame(spark, rows)
    want = Counter()
    for r in mixing.mix(docs).collect():
        if r["size"]:
            want[r["doc_id"]] += r["taken"] // r["size"]
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == +want
    assert mixing.mix(frame(spark, [])).count() == 0 and mixing.mixed_documents(frame(spark, [])).count() == 0


def test_key_ranges_are_even_and_in_order(spark):
    from pyspark.sql import functions as F

    # 2 of 3 documents are light: their keys are long, yet no range holds many of them.
    df = spark.range(30_000).withColumn("w", F.element_at(F.array(*[F.lit(w) for w in (1.0, 0.25, 0.25)]), (F.col("id") % 3 + 1).cast("int")))
    df = df.withColumn("key", -F.log(mixing.uniform(F.col("id"))) / F.col("w"))
    rows = df.select("key", mixing.key_range(F.col("key"), [1 / 3, 0.0, 2 / 3], 100).alias("b")).orderBy("key").collect()
    held = Counter(r["b"] for r in rows)
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows)
    assert set(held) == set(range(100)) and max(held.values()) < 400


def test_heavier_documents_come_first():
    n = 4000
    u = np.random.default_rng(0).random(n)
    w = np.where(np.arange(n) % 2, 1.0, 0.25)
    first = np.argsort(-np.log(u) / w)[:1000]
    assert (w[first] == 1.0).mean() > 0.7


# ----------------------------------------------------------------- sentencepiece

needs_model = pytest.mark.skipif(not os.path.exists(sentencepiece.MODEL), reason="no vocabulary file")


@needs_model
def test_sentencepiece_round_trip_and_reruns(spark):
    rows = corpus()
    a = sentencepiece.encode(frame(spark, rows)).collect()
    b = sentencepiece.encode(frame(spark, rows, 2)).collect()
    key = lambda r: (r["doc_id"], tuple(r["ids"]))
    assert Counter(map(key, a)) == Counter(map(key, b))
    assert all(r["lossless"] and r["n_pieces"] == len(r["ids"]) for r in a)
    back = sentencepiece.decode(spark.createDataFrame([(r["doc_id"], r["ids"]) for r in a], "doc_id bigint, ids array<int>"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((i, t or "") for i, t, *_ in rows)
    assert sentencepiece.encode(frame(spark, [])).count() == 0


@needs_model
def test_sentencepiece_samples_the_lattice_distribution():
    pieces = sentencepiece.load_pieces()
    alpha, text, n = 0.3, "there", 20000
    got, count = sentencepiece.Lattices(pieces, alpha).sample([text] * n, np.arange(n, dtype=np.uint64) * np.uint64(7919))
    cut = np.cumsum(count)
    seen = Counter(tuple(got[e - k:e].tolist()) for e, k in zip(cut, count))
    index = {t.replace("▁", " "): i for i, t in enumerate(pieces.text) if pieces.log_p[i] == pieces.log_p[i]}

    def ways(rest):
        if not rest:
            yield (), 1.0
        for k in range(1, len(rest) + 1):
            i = index.get(rest[:k])
            if i is not None:
                for tail, p in ways(rest[k:]):
                    yield (i, *tail), p * math.exp(alpha * pieces.log_p[i])

    p = dict(ways(" " + text))
    total = sum(p.values())
    assert set(seen) <= set(p) and len(seen) > 5
    for way, x in p.items():
        q = x / total
        assert abs(seen[way] / n - q) < 5 * math.sqrt(q / n) + 1e-4


# ------------------------------------------------------------------ fingerprints


def brute_class(window):
    c = Counter(window)
    h = math.log2(64) - sum(v * math.log2(v) for v in c.values()) / 64
    return h / 6 * fingerprint.CLASSES


def test_entropy_classes_slide():
    data = np.frombuffer(("".join(t or "" for _, t, *_ in corpus()[:20]) + "a" * 200).encode(), np.uint8)
    got = fingerprint.entropy_classes(data)
    for i in range(0, len(got), 37):
        assert abs(got[i] + 0.5 - min(brute_class(data[i:i + 64].tolist()), 1000)) <= 0.5001


def test_fingerprint_features_against_brute_force():
    ranks = fingerprint.class_ranks(np.arange(1001)[::-1].copy())
    for _, t, *_ in corpus()[:15]:
        data = np.frombuffer((t or "").encode(), np.uint8)
        rank = ranks[fingerprint.entropy_classes(data)].tolist()
        votes = Counter()
        span = min(64, len(rank))
        for i in range(len(rank) - span + 1):
            j = min(range(i, i + span), key=lambda k: (rank[k], k))
            if rank[j] <= fingerprint.CLASSES:
                votes[j] += 1
        chosen = sorted(j for j, v in votes.items() if v >= 16)
        want = list(dict.fromkeys(bytes(data[j:j + 64]) for j in chosen))
        assert len(fingerprint.features(data, ranks)) == max(len(want), 1 if len(data) else 0)


def test_likeness_against_brute_force():
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 2**63, 500).astype(np.uint64)

    def plain(a, b):
        if len(a[0]) > len(b[0]):
            a, b = b, a
        score = 0.0
        for bits, n in zip(*a):
            x = {i for i, v in enumerate(bits) if v}
            best = 0.0
            for other in b[0]:
                y = {i for i, v in enumerate(other) if v}
                most, chance = min(len(x), len(y)), len(x) * len(y) / fingerprint.FILTER_BITS
                best = max(best, min(1.0, (len(x & y) - chance) / max(most - chance, 1e-6)))
            score += n * best
        return score / sum(a[1])

    for own, size in ((0, 400), (30, 100), (200, 330), (400, 50)):
        a = fingerprint.bloom_chain(shared[:size])
        b = fingerprint.bloom_chain(np.concatenate([shared[: size - min(own, size)], rng.integers(0, 2**63, own).astype(np.uint64)]))
        assert int(a[1].sum()) == size and len(a[0]) == -(-size // fingerprint.FILTER_FEATURES)
        assert math.isclose(fingerprint.likeness(a, b), fingerprint.likeness(b, a))
        if len(a[0]) != len(b[0]):
            assert math.isclose(fingerprint.likeness(a, b), plain(a, b), abs_tol=1e-5)
        else:
            assert min(abs(fingerprint.likeness(a, b) - plain(a, b)), abs(fingerprint.likeness(a, b) - plain(b, a))) < 1e-5
        assert fingerprint.likeness(a, a) == 1.0 and (own or fingerprint.likeness(a, b) == 1.0)
    none = fingerprint.bloom_chain(shared[:0])
    assert fingerprint.likeness(none, none) == 1.0 and fingerprint.likeness(none, a) == 0.0


def test_fingerprint_edits_against_successors(spark):
    rows = [r for r in corpus(n=90) if r[0] != 1004]
    df = frame(spark, rows)
    blocks = fingerprint.BLOCK_ROWS
    try:
        fingerprint.in_blocks.__defaults__ = (9,)  # many blocks
        got = fingerprint.fingerprint_edits(df).collect()
    finally:
        fingerprint.in_blocks.__defaults__ = (blocks,)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter()
    for a, b in zip(order, order[1:] + order[:1]):
        x, y = a[1] or "", b[1] or ""
        half = len(x) // 2
        want[(a[0], len(x), hashlib.sha256((x[:len(x) - half] + y[:half]).encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    text_of = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    by_text = {}
    for r in got:
        if r["doc_id"] is not None:
            assert by_text.setdefault(text_of[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        a, b = fingerprint.from_text(r["fingerprint"]), fingerprint.from_text(r["edited_fingerprint"])
        assert r["near_edited"] == fingerprint.likeness(a, b) and 0 <= r["near_next"] <= 1
        assert fingerprint.likeness(a, a) == 1.0
    long = [r for r in got if 800 < r["n_chars"] < 20000 and r["doc_id"] not in (1006, 1007, 1008, 1009)]
    assert np.mean([r["near_edited"] for r in long]) > 0.35
    assert fingerprint.fingerprint_edits(frame(spark, [])).count() == 0
    one = fingerprint.fingerprint_edits(frame(spark, [(1, "abcd", "en", "s")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
