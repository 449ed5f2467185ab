import hashlib
import math
import os
import sys
from collections import Counter, defaultdict

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixture import components, corpus, words
from test_llm_dedup import brute_cut, brute_fp
from test_llm_models import brute_stats
from test_llm_text import brute_targets

import __spark_entry__ as E
import corpus_pipeline
from corvid.llm import catalog, mixing, quality, sentencepiece


def brute_mix(docs):
    """How often each of ``{id: (text, source)}`` is taken."""
    size = {i: len(words(t)) for i, (t, _) in docs.items()}
    by = defaultdict(list)
    for i, (t, source) in docs.items():
        u = (int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        weight = (1.0 if size[i] >= 50 else 0.5) * (1.0 if 3 <= len(t) / max(size[i], 1) <= 12 else 0.5)
        by[source].append((-math.log(u) / weight, i))
    total = {s: sum(size[i] for _, i in of) for s, of in by.items()}
    target = brute_targets(total, sum(total.values()))
    out = Counter()
    for s, of in by.items():
        epochs = int(target[s] // total[s])
        rest, until = target[s] - epochs * total[s], 0
        for _, i in sorted(of):
            until += size[i]
            out[i] = epochs + (rest > 0 and until - size[i] / 2 <= rest)
    return +out


def test_pipeline_against_brute_force(spark, tmp_path):
    rows = [r for r in corpus(n=120) if r[0] not in (None, 1004)]
    odd = [(2000 + i, " ".join(f"w{i}x{j}##$$%%||" for j in range(120)), "en", "hot") for i in range(6)]
    rows += odd
    cols = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], cols).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, 1, 0) for i, *_ in rows if i < 1000 and i % 2] + [(i, 0, 0) for i, *_ in odd[:4]] + [(None, 0, 0), (77777, 0, 1)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    told = {r["doc_id"]: r["kept"] for r in quality.judge(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.append([tuple(r) for r in docs.collect()])
    # Quality: the base rule exactly; of the others the labelled kind goes, plain prose stays.
    sound = {i for i, t, *_ in rows if not ((s := brute_stats(t))[0] < 50 or 100 * s[4] > 50 * s[0])}
    kept = {r[0]: r[1] for r in out[0]}
    assert {i for i, ok in told.items() if ok} == set(kept) <= sound
    assert not set(kept) & {i for i, *_ in odd} and {i for i in sound if i < 1000} <= set(kept)
    assert Counter(out[0]) == Counter((*r, len(r[1])) for r in rows if r[0] in kept)
    # Near duplicates: exactly the smallest id of every component.
    fps = {i: brute_fp(t) for i, t in kept.items()}
    nodes = sorted(set(fps.values()))
    label = components(nodes, [(a, b) for a in nodes for b in nodes if a < b and bin(a ^ b).count("1") <= 4])
    heads = {min(i for i in fps if label[fps[i]] == g) for g in set(label.values())}
    assert len(heads) < len(kept) and Counter(out[1]) == Counter(r for r in out[0] if r[0] in heads)
    # Substrings: exactly the words that no window takes away.
    want = {i: (n - gone, sha) for i, n, gone, sha in brute_cut([(r[0], r[1]) for r in out[1]], 50)}
    assert {r[0] for r in out[2]} == {i for i, (n, _) in want.items() if n} and len(out[2]) == len({r[0] for r in out[2]})
    assert any(want[r[0]][0] < len(words(r[1])) for r in out[1])
    for i, t, _, _, n in out[2]:
        assert (hashlib.sha256(" ".join(words(t)).encode()).hexdigest(), n) == (want[i][1], len(t))
    # Mixing: exactly as often as the targets say.
    times = brute_mix({r[0]: (r[1], r[3]) for r in out[2]})
    assert max(times.values()) > 1 and Counter(out[3]) == Counter({r: times[r[0]] for r in out[2] if times[r[0]]})
    # Encoding: the final ids decode to the mixed texts.
    final = corpus_pipeline.run(spark, str(tmp_path)).cache()
    assert all(r["lossless"] for r in final.collect())
    back = sentencepiece.decode(final).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((r[0], r[1]) for r in out[3])


def test_every_operator_is_registered_once():
    names = set(E.queries())
    assert set(catalog.QUERIES) <= names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
    assert [k for k, _ in corpus_pipeline.STAGES][0] == "quality_rules" and len(corpus_pipeline.STAGES) == 5
