"""Conversation structure repair by alignment to an alternating grammar (12).

A conversation's role initials should read ``(s?(ua)+)?``. Edits: Keep a turn (0), Rerole it
to user or assistant (3), Delete it (4), Insert an empty user or assistant turn (3). Blank
and duplicate turns must be deleted; a truncated turn that stays costs 3 more.

The alignment is Wagner-Fischer against every feasible length of the grammar's string. All
those strings end in ``...uaua``, so the cost ``S[i][r]`` of aligning the turns from ``i`` on
with a string's last ``r`` characters serves every length at once: the strings without ``s``
are the even columns of row 0, and for those with ``s`` a second table ``Q`` holds the cost
while the ``s`` is still to come (only a kept system turn can be it). Only diagonals inside
Ukkonen's band are computed: an incumbent (a full alignment found in a narrow band) bounds
how many more insertions or deletions than forced any better alignment can have, and the
band is widened to that. The audits of all lengths at the least cost are traced together,
letter by letter, and the ASCII-least letter wins.

Memory is the band times the square root of the turns (rows are kept at intervals and
computed again when they are traced). Conversations with the same pattern of initials and
faults share one alignment.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
INF = 1 << 28
KEPT_CELLS = 1 << 20      # rows are all kept below this many cells of a table
PATTERNS = 1 << 16        # alignments remembered by a worker, of patterns up to 64 turns

CLASSES = "sua"           # a role's class: its initial, or 3 for any other
LETTERS = "abcdefghijkl"  # a turn in a pattern: class + 4 * (0 sound, 1 truncated, 2 to be deleted)


class _Alignment:
    def __init__(self, pattern: str, less: int, more: int):
        code = np.frombuffer(pattern.encode(), np.uint8) - ord("a")
        self.cls, self.cut, self.gone = code % 4, (code // 4 == 1).astype(np.int32) * TRUNCATED, code // 4 == 2
        self.n = len(code)
        self.live = np.concatenate([np.cumsum(~self.gone[::-1])[::-1], np.zeros(1, np.int64)])  # turns to place from i on
        self.less, self.more = less, more
        self.width = less + more + 3
        self.x = np.arange(self.width, dtype=np.int32)
        step = self.n + 1 if (self.n + 1) * self.width <= KEPT_CELLS else max(1, math.isqrt(self.n))
        self.step = step
        self.marks = {}
        row = self._last()
        self.marks[self.n] = row
        self.rows: dict[int, tuple] = {self.n: row}
        for i in range(self.n - 1, -1, -1):
            row = self._up(i, row)
            if step > self.n or i < step:
                self.rows[i] = row
            if i % step == 0:
                self.marks[i] = row
        if step <= self.n:
            self.rows.pop(self.n, None)
        s, q = row
        r = self.r(0)
        even = (r >= 0) & (r % 2 == 0)
        self.cost = int(min(s[even].min(initial=INF), q.min(initial=INF)))

    def r(self, i: int) -> np.ndarray:
        """The string lengths of row ``i``'s cells."""
        return self.x + int(self.live[i]) - self.less - 1

    def _spread(self, s: np.ndarray) -> np.ndarray:
        """Insertions along a row."""
        return np.minimum.accumulate(s - INSERT * self.x) + INSERT * self.x

    def _last(self) -> tuple:
        r = self.r(self.n)
        return np.where(r >= 0, INSERT * r, INF).astype(np.int32), np.full(self.width, INF, np.int32)

    def _moves(self, i: int, row: tuple) -> tuple:
        """Costs by deletion and by keeping or reroling turn ``i``, of ``S`` and ``Q``."""
        s, q = row
        if self.gone[i]:
            none = np.full(self.width, INF, np.int32)
            return s + DELETE, none, none, q + DELETE, none
        r = self.r(i)
        down = lambda v: np.append(v[1:], INF).astype(np.int32)  # noqa: E731 - the same r one row below
        fits = (r % 2 == 0) == (self.cls[i] == 1) if self.cls[i] in (1, 2) else np.zeros(self.width, bool)
        pair = np.where(r >= 1, s + self.cut[i], INF)
        start = np.where((r >= 2) & (r % 2 == 0), down(s) + self.cut[i], INF) if self.cls[i] == 0 else np.full(self.width, INF)
        return (down(s) + DELETE, np.where(fits, pair + KEEP, INF), np.where(fits, INF, pair + REROLE),
                down(q) + DELETE, start)

    def _up(self, i: int, row: tuple) -> tuple:
        sd, sk, sr, qd, qk = self._moves(i, row)
        s = np.where(self.r(i) >= 0, np.minimum(np.minimum(sd, sk), sr), INF)
        return np.minimum(self._spread(s), INF).astype(np.int32), np.minimum(np.minimum(qd, qk), INF).astype(np.int32)

    def row(self, i: int) -> tuple:
        if i not in self.rows:  # the block of rows from the mark before i to the mark after it
            a = i - i % self.step
            b = min(a + self.step, self.n)
            self.rows = {b: self.marks[b]}
            for k in range(b - 1, a - 1, -1):
                self.rows[k] = self._up(k, self.rows[k + 1])
        return self.rows[i]

    def audit(self) -> str:
        """The ASCII-least audit among all alignments at the least cost, of all lengths."""
        out, i = [], 0
        s, q = self.row(0)
        r = self.r(0)
        at, pending = (s == self.cost) & (r >= 0) & (r % 2 == 0), q == self.cost
        while True:
            r = self.r(i)
            if i == self.n and at[r == 0].any():
                return "".join(out)
            s, q = self.row(i)
            if i < self.n:
                sd, sk, sr, qd, qk = self._moves(i, self.row(i + 1))
                down = lambda v: v if self.gone[i] else np.append(False, v[:-1])  # noqa: E731 - the same r in row i + 1
                d, dq = at & (s == sd), pending & (q == qd)
                if d.any() or dq.any():
                    out.append("D")
                    at, pending, i = down(d), down(dq), i + 1
                    continue
            ins = at & (r >= 1) & (s == np.append(INF, s[:-1]) + INSERT)
            if ins.any():
                out.append("I")
                at, pending = np.append(ins[1:], False), np.zeros_like(pending)
                continue
            k, kq = at & (s == sk), pending & (q == qk)
            if k.any() or kq.any():
                out.append("K")
                at, pending, i = k | down(kq), np.zeros_like(pending), i + 1
                continue
            out.append("R")
            at, pending, i = at & (s == sr), np.zeros_like(pending), i + 1


def align(pattern: str) -> tuple[int, str]:
    """``(cost, audit)`` of a conversation's pattern (a letter of ``LETTERS`` per turn)."""
    code = np.frombuffer(pattern.encode(), np.uint8) - ord("a")
    gone, cut = int((code // 4 == 2).sum()), int((code // 4 == 1).sum())
    floor = DELETE * gone + TRUNCATED * cut  # no alignment costs less
    less = more = 2
    while True:
        got = _Alignment(pattern, less, more)
        over = got.cost - floor
        # An alignment with k more insertions pays 3 each; with k more deletions 4 each, or 1
        # for a truncated turn, which costs 3 if it stays.
        need_more = over // INSERT
        need_less = over if over <= cut else cut + (over - cut) // DELETE
        if need_more <= more and need_less <= less:
            return got.cost, got.audit()
        less, more = max(less, min(need_less, 2 * less)), max(more, min(need_more, 2 * more))


_patterns: dict[str, tuple[int, str]] = {}


def _aligned(pattern: str) -> tuple[int, str]:
    got = _patterns.get(pattern)
    if got is None:
        got = align(pattern)
        if len(pattern) <= 64:
            if len(_patterns) >= PATTERNS:
                _patterns.clear()
            _patterns[pattern] = got
    return got


def _plan(audit: str) -> tuple[list[int], list[str | None]]:
    """Of each turn of the repaired conversation: its source turn (from 1, 0 for an inserted
    one) and its new role, if any. The audit gives the string's length and so its roles."""
    size = len(audit) - audit.count("D")
    take, made, turn = [], [], 0
    for a in audit:
        turn += a != "I"
        if a != "D":
            take.append(0 if a == "I" else turn)
            made.append(None if a == "K" else "assistant" if (size - len(made)) % 2 else "user")
    return take, made


REPAIR = ("blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "take array<int>, made array<string>")


def _repairs(pattern: pd.Series, keys: pd.Series) -> pd.DataFrame:
    rows = []
    for p, ks in zip(pattern, keys):
        seen, letters, faults = set(), [], [0, 0, 0]
        for c, k in zip(p, ks):
            x = LETTERS.index(c)
            state = x // 4
            if state == 2:
                faults[0] += 1
            elif k in seen:
                faults[1], state = faults[1] + 1, 2
            elif state == 1:
                faults[2] += 1
            seen.add(k)
            letters.append(LETTERS[x % 4 + 4 * state])
        cls = [LETTERS.index(c) % 4 for c in p]
        illegal = sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in zip(cls, cls[1:]))
        cost, audit = _aligned("".join(letters))
        rows.append((*faults, illegal, cost, audit, *_plan(audit)))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in REPAIR.split(", ")])


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present_col: str | None = None) -> DataFrame:
    """``(conv_id, n_turns, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired
    array<struct<role, text>>)``, one row per conversation (null ids are one conversation).

    Turns are taken by number (null numbers first; equal numbers by role, then text). A
    turn's first fault counts: blank (no character but white space), duplicate (role and text
    of an earlier turn), truncated (its last such character is none of ``.!?``). A null role
    or text is empty. Rows whose ``present_col`` is not true are no turns; they only name
    their conversation, which is then returned even without turns (zeros, empty audit).
    ``gaps`` is null where the turn numbers span more than 64 bits. Other columns are not
    read. A conversation is one output value, so its turns meet in one row; what is aligned
    is one letter per turn, computed before the exchange.
    """
    present = F.lit(True) if present_col is None else F.coalesce(F.col(present_col), F.lit(False))
    src = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), present.alias("_present"))
    cls = F.coalesce(F.array_position(F.array(*map(F.lit, CLASSES)), F.substring("role", 1, 1)), F.lit(0))
    cls = F.when(cls == 0, 3).otherwise(cls - 1)
    solid = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    state = (F.when(solid == "", 2).when(F.substring(solid, -1, 1).isin(".", "!", "?"), 0).otherwise(1))
    letter = F.substring(F.lit(LETTERS), (cls + 4 * state + 1).cast("int"), F.lit(1))
    key = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    row = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "role", "text", letter.alias("letter"), key.alias("key"))
    whole = src.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.when(F.col("_present"), row))).alias("turns"))
    fix = F.pandas_udf(_repairs, REPAIR)
    numbers = F.filter(F.transform("turns", lambda t: t["turn"]), lambda x: x.isNotNull())
    span = (F.array_max(numbers).cast("decimal(38,0)") - F.array_min(numbers) + 1 - F.size(F.array_distinct(numbers)))
    gaps = F.when(F.size(numbers) == 0, F.lit(0).cast("bigint")).otherwise(span.try_cast("bigint"))
    fixed = whole.select("conv_id", "turns", F.size("turns").cast("bigint").alias("n_turns"), gaps.alias("gaps"),
                         fix(F.array_join(F.transform("turns", lambda t: t["letter"]), ""),
                             F.transform("turns", lambda t: t["key"])).alias("fix"))
    repaired = F.zip_with("fix.take", "fix.made", lambda i, r: F.struct(
        F.coalesce(r, F.get("turns", i - 1)["role"]).alias("role"),
        F.coalesce(F.get("turns", i - 1)["text"], F.lit("")).alias("text")))
    return fixed.select("conv_id", "n_turns", "gaps", "fix.blank", "fix.duplicate", "fix.truncated", "fix.illegal", "fix.cost",
                        "fix.audit", repaired.alias("repaired"))


def damage(turns: DataFrame) -> DataFrame:
    """The rows of ``(conv_id, turn, role, text)`` with faults put in by
    ``crc32("conv_id:turn") % 20`` (0 drops the row, 1 empties its text, 2 removes its ``.!?``,
    3 repeats it, 4 makes it a user's; a null anywhere is one space) and ``present``: false
    for a dropped row."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    src = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("_kind"))
    text = (F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    return src.select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                      text.alias("text"), (F.col("_kind") != 0).alias("present"),
                      F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
                      ).drop("_copy")
