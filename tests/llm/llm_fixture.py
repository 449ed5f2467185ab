"""A small corpus with the awkward cases, and plain-Python versions to compare with."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, key string, "
          "row_hash string, size int, score double, h int, block int")


def prose(rng, n, vocab=400):
    words = [f"w{int(rng.paretovariate(0.7)) % vocab}" for _ in range(n)]
    return " ".join(words) + "."


def corpus(seed=1, n=60):
    """(doc_id, text, lang, source): copies, near copies, shared passages, repeats, nulls."""
    rng = random.Random(seed)
    passage = prose(rng, 70)
    rows = []
    for i in range(n):
        t = prose(rng, rng.randint(40, 200))
        if i % 7 == 3:
            t = t + "\n" + passage + "\n" + prose(rng, 30)
        if i % 10 == 4 and i > 10:
            t = rows[i - 10][1]
        if i % 10 == 6 and i > 10:
            t = (rows[i - 3][1] or "") + " extra"
        rows.append((i * 3, t, "en", "hot" if i % 3 == 0 else f"s{i % 5}"))
    rows += [(1001, None, None, None), (1002, "", "en", "s1"), (1003, " \t\n\x0b ", "en", None),
             (1004, "one", "fr", "tiny"), (1005, "Ünï cödé 😀 <s> [INST] ▁▁ \x00 \\ x", "de", "s2"),
             (1006, "same " * 120, "en", "s2"), (1007, "same " * 300, "en", "s2"),
             (1008, "a b " * 90, "en", "s1"), (1009, "a b " * 70, "en", "s1"), (1010, "longword" * 3000, "en", "s3"),
             (1011, prose(rng, 6000, 3000), "en", "hot"), (1012, "line one here\n" * 30 + prose(rng, 80), "en", "s3"),
             (None, "null id " + prose(rng, 90), "en", "s4"), (None, None, None, None),
             (1013, "x ### $$$ " * 60, "en", "s3"), (1004, "one", "fr", "tiny"), (1004, "two texts one id", "fr", "tiny")]
    return rows


def frame(spark, rows, parts=5):
    full = [(i, t, lang, s, None if t is None else len(t), 1, "k", None, 2, 0.5, 3, 4) for i, t, lang, s in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.repartition(parts) if rows else df


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
