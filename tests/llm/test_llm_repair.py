import hashlib
import os
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from corvid.llm import catalog, repair

WS = "\x20\x09\x0a\x0b\x0c\x0d"


def brute_align(rows):
    """rows: (initial, fault) -> (cost, audit), trying every target string by plain recursion."""
    n, best = len(rows), None
    for m in [0, *range(2, 2 * n + 5)]:
        target = ("s" if m % 2 else "") + "ua" * (m // 2)

        @lru_cache(None)
        def f(i, j):
            if i == n and j == m:
                return 0, ""
            ways = []
            if i < n:
                c, a = f(i + 1, j)
                ways.append((c + 4, "D" + a))
                initial, fault = rows[i]
                if j < m and fault not in ("blank", "duplicate"):
                    c, a = f(i + 1, j + 1)
                    c += 3 * (fault == "truncated")
                    if initial == target[j]:
                        ways.append((c, "K" + a))
                    elif target[j] != "s":
                        ways.append((c + 3, "R" + a))
            if j < m and target[j] != "s":
                c, a = f(i, j + 1)
                ways.append((c + 3, "I" + a))
            return min(ways) if ways else (1 << 20, "")

        best = min(best or f(0, 0), f(0, 0))
    return best


def brute_op12(rows):
    """The contract in plain Python."""
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[c] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        faults, seen = [], set()
        for _, role, text in turns:
            solid = text.strip(WS)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        numbers = [t for t, *_ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[:1] for _, r, _ in turns]
        cost, audit = brute_align(list(zip(initials, faults)))
        size, made, i = len(audit) - audit.count("D"), [], 0
        for a in audit:
            new = "user" if (size - len(made)) % 2 == 0 else "assistant"
            if a != "D":
                made.append(f"{turns[i][1] if a == 'K' else new}:{'' if a == 'I' else turns[i][2]}")
            i += a != "I"
        out.append((c, gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return out


def test_alignment_against_every_target_string():
    rng = random.Random(5)
    names = {k: ("suao"[k % 4], ["", "truncated", "blank"][k // 4]) for k in range(12)}
    for k in range(1200):
        p = "".join(rng.choice(repair.LETTERS if k % 2 else "bcbcbcbcbcabcdfgjk") for _ in range(rng.randint(0, 8)))
        assert repair.align(p) == brute_align([names[repair.LETTERS.index(c)] for c in p]), p


def test_alignment_in_blocks_of_rows(monkeypatch):
    rng = random.Random(6)
    ps = ["".join(rng.choice("bcbcbcbcbcabcdfgjk") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    whole = [repair.align(p) for p in ps]
    monkeypatch.setattr(repair, "KEPT_CELLS", 50)
    assert [repair.align(p) for p in ps] == whole
    long = "bc" * 1500
    assert repair.align(long) == (0, "K" * 3000)
    cost, audit = repair.align("b" + "bc" * 800 + "i" * 3 + "bc" * 300 + "b")
    assert cost == 3 + 3 * 4 + 3 and audit.count("I") == 2 and audit.count("D") == 3


TEXTS = ["Fine.", "cut off", "", None, " \t\n", "Really?", "no end ", "Fine.", "Ünï!", "ends\n. ", "\x00", "say: ok!"]


def conversations(seed=2):
    rng = random.Random(seed)
    rows = []
    for c in [*range(60), None, -5]:
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"] if t else ["system", "user"]) if rng.random() < 0.8 else rng.choice(
                ["tool", None, "", "s", "User", "assistant"])
            rows.append((c, rng.choice([t, t, t, t + 3, None]), role, rng.choice(TEXTS)))
    return rows


def test_query_against_plain_python(spark, tmp_path):
    rows = conversations()
    # Extra columns with the names that the operator uses itself.
    wide = [(*r, "x", 1, True) for r in rows]
    spark.createDataFrame(wide, "conv_id bigint, turn bigint, role string, text string, audit string, _kind int, present boolean"
                          ).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in catalog.op12_conversation_repair(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_op12(rows)))
    assert len({g[7] for g in got}) > 10 and any("I" in g[7] for g in got) and any("R" in g[7] for g in got)


def test_all_rows_dropped_and_empty_table(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    df.write.parquet(f"{tmp_path}/a/conversations.parquet")
    got = [tuple(r) for r in catalog.op12_conversation_repair(spark, f"{tmp_path}/a").collect()]
    assert got == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    df.limit(0).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert catalog.op12_conversation_repair(spark, f"{tmp_path}/b").collect() == []


def test_repaired_turns_and_far_numbers(spark):
    rows = [(1, -(1 << 63), "user", "Hi."), (1, (1 << 63) - 1, "assistant", "x" * 300_000 + "."), (2, 1, "assistant", "So."), (2, 2, "user", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in repair.repair(df).collect()}
    assert got[1]["gaps"] is None and got[1]["audit"] == "KK" and len(got[1]["repaired"][1]["text"]) == 300_001
    assert got[2]["audit"] == "IKD" and [(t["role"], t["text"]) for t in got[2]["repaired"]] == [("user", ""), ("assistant", "So.")]
    assert got[2]["blank"] == 1 and got[2]["cost"] == 7


@pytest.mark.parametrize("n", [0, 1, 2])
def test_short_patterns(n):
    assert repair.align("b" * n)[0] == [0, 3, 3][n]
