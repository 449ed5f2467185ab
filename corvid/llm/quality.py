"""Quality rules judged by isolation forests on rule statistics.

One pass over the texts counts, per document: words, code points in words, symbol
characters, repeated lines, and words inside repeated 3-word windows, the rules' statistics
as they are (``RATES``), and for each rule of ``LIMITS`` how far its statistic is beyond the
limit (0 within). The base rule rejects short and repetitive texts. Two forests of
random-split trees are then grown on a bounded sample of documents (``TREES`` x ``TREE_ROWS``
rows, the smallest hashes of id and tree): one on the excesses, one on the statistics, which
also vary inside the limits. Every tree also gets the rows that are the whole table's least
and greatest of each feature, so its splits span the table's range and a violation that no
sampled row has is split off. Short mean path lengths mark anomalies. The thresholds are
calibrated on *all* labelled rows that pass the base rule, the excesses' first, then the
statistics' on what it leaves: per score bin the labels are counted, and the cut is the one
with the best balance: the share of bad rows it rejects, less ``GOOD_COST`` times the share
of good rows. A document is rejected if either forest does.

Null text: no words (fails the base rule). Null id: scored and judged, not used to fit.
Repeated rows each get a row. Without usable labels, or an empty table, nothing beyond the
base rule is rejected. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import range_hash, slices, smallest_hashes, tokens
from corvid.session import cut_lineage

MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
TREES = 100
TREE_ROWS = 256      # rows that a tree is grown on
GOOD_COST = 20.0     # a rejected share of the good rows weighs so many times one of the bad
BINS = 1000
SEED = 7

STATS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
#: Limits of the rules (share of words or of word characters; mean code points a word).
LIMITS = {"symbol_excess": 0.1, "dup_line_excess": 0.3, "upper_excess": 0.3, "bang_excess": 0.05, "digit_excess": 0.3,
          "word_length_excess": (3.0, 12.0)}
#: The statistics themselves: shares of words or of word characters, and logarithms of sizes.
RATES = ("symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "bang_rate", "digit_rate", "log_word_length", "log_words")
#: The forests, by the column of their score, in the order of their calibration.
FORESTS = {"anomaly": tuple(LIMITS), "oddness": RATES}
FEATURES = (*LIMITS, *RATES)
_MORE = ", ".join(f"{c} double" for c in FEATURES)


def _prefix(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(x, dtype=np.int64)])


def _repeats(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (group, value) rows in text order: which are equal to an earlier one, and which
    have an equal one anywhere."""
    order = np.lexsort((values, group))
    v, g = values[order], group[order]
    same = np.zeros(len(v), bool)
    same[1:] = (v[1:] == v[:-1]) & (g[1:] == g[:-1])
    later, twice = np.zeros(len(v), bool), np.zeros(len(v), bool)
    later[order] = same
    same[:-1] |= same[1:]
    twice[order] = same
    return later, twice


def slice_stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Rule statistics of every text of a slice."""
    n_docs = len(offsets) - 1
    t = tokens(data, offsets)
    n = t.counts
    doc = np.repeat(np.arange(n_docs), n)
    per_doc = lambda total: total[offsets[1:]] - total[offsets[:-1]]
    chars = _prefix((data & 0xC0) != 0x80)
    word_chars = np.zeros(n_docs, np.int64)
    np.add.at(word_chars, doc, chars[t.ends] - chars[t.starts])
    of = np.zeros(256, bool)
    of[list(SYMBOLS)] = True
    symbols = per_doc(_prefix(of[data]))
    # Repeated 3-word windows: mark their words, the first occurrence's included.
    h = range_hash(data, t.starts, t.ends)
    w = np.maximum(n - 2, 0)
    wdoc = np.repeat(np.arange(n_docs), w)
    at = t.first[:-1][wdoc] + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
    _, twice = _repeats(range_hash(h, at, at + 3), wdoc)
    hit = np.zeros(len(h) + 3, bool)
    for k in range(3):
        hit[at[twice] + k] = True
    repeat_words = np.bincount(doc[hit[: len(doc)]], minlength=n_docs) if n_docs else n
    # Lines: \n-split; only those with a word count.
    lines = tokens(data, offsets, lambda b: b == 10)
    ldoc = np.repeat(np.arange(n_docs), lines.counts)
    words_in = np.searchsorted(t.starts, lines.ends) - np.searchsorted(t.starts, lines.starts)
    later, _ = _repeats(range_hash(data, lines.starts, lines.ends), ldoc)
    dup = later & (words_in > 0)
    dup_lines = np.bincount(ldoc[dup], minlength=n_docs)
    dup_words = np.bincount(ldoc[dup], weights=words_in[dup], minlength=n_docs)
    size = np.maximum(n, 1)
    share = lambda mask: per_doc(_prefix(mask)) / np.maximum(word_chars, 1)
    over = lambda rule, x: np.maximum(x - LIMITS[rule], 0.0)
    length, (short, long) = word_chars / size, LIMITS["word_length_excess"]
    rates = {"symbol": symbols / size, "dup_line": dup_words / size, "upper": share((data >= 65) & (data <= 90)),
             "bang": share((data == 33) | (data == 63)), "digit": share((data >= 48) & (data <= 57))}
    return {"n_words": n, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
            "n_repeat_words": repeat_words,
            **{f"{k}_rate": x for k, x in rates.items()}, "repeat_rate": repeat_words / size,
            "log_word_length": np.log1p(length), "log_words": np.log1p(n),
            **{f"{k}_excess": over(f"{k}_excess", x) for k, x in rates.items()},
            "word_length_excess": np.where(n > 0, np.maximum(np.maximum(length - long, short - length), 0.0), 0.0)}


def rule_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the five counts and the forest's features, one row per input row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ints = [c.split()[0] for c in STATS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            x = slice_stats(s.data, s.offsets)
            yield pa.RecordBatch.from_arrays(
                [s.batch.column("doc_id"), *(pa.array(x[c].astype(np.int64)) for c in ints),
                 *(pa.array(x[c].astype(np.float64)) for c in FEATURES)], ["doc_id", *ints, *FEATURES])

    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, {STATS}, {_MORE}")


# ------------------------------------------------------------------- isolation forest


def grow_tree(x: np.ndarray, rng: np.random.Generator, depth: int) -> list[list[float]]:
    """One tree as rows [feature, split, left, right, size]; feature -1 marks a leaf."""
    nodes: list[list[float]] = []

    def grow(rows: np.ndarray, left: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, len(rows)])
        low, high = (x[rows].min(0), x[rows].max(0)) if len(rows) else (np.zeros(0), np.zeros(0))
        usable = np.flatnonzero(high > low)
        if left and len(usable):
            f = int(rng.choice(usable))
            cut = float(rng.uniform(low[f], high[f]))
            go = x[rows, f] <= cut
            nodes[me][:2] = [f, cut]
            nodes[me][2] = grow(rows[go], left - 1)
            nodes[me][3] = grow(rows[~go], left - 1)
        return me

    grow(np.arange(len(x)), depth)
    return nodes


def mean_unsuccessful(n: np.ndarray) -> np.ndarray:
    """c(n): mean path length of an unsuccessful search in a binary tree of n rows."""
    m = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


def anomaly(trees: list[np.ndarray], x: np.ndarray, rows: int) -> np.ndarray:
    """2 ** (-mean path length / c(rows)): near 1 is anomalous, below a half is not."""
    total = np.zeros(len(x))
    for t in trees:
        at, depth = np.zeros(len(x), np.int64), np.zeros(len(x))
        live = np.flatnonzero(t[at, 0] >= 0)
        while len(live):
            node = t[at[live]]
            go = x[live, node[:, 0].astype(np.int64)] <= node[:, 1]
            at[live] = np.where(go, node[:, 2], node[:, 3]).astype(np.int64)
            depth[live] += 1
            live = live[t[at[live], 0] >= 0]
        total += depth + mean_unsuccessful(t[at, 4])
    return 2.0 ** (-total / max(len(trees), 1) / max(float(mean_unsuccessful(np.array([rows]))[0]), 1e-9))


def fit_forests(stats: DataFrame, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> dict[str, list[np.ndarray]]:
    """Per forest, trees on ``rows`` documents each, from the ``trees * rows`` smallest hashes
    of the ids that pass the base rule, and on the rows with the least and greatest value of
    each of its features among all that pass (the only rows that reach the driver)."""
    usable = stats.filter(F.col("doc_id").isNotNull() & ~failed()).select(
        F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("h"), *FEATURES)
    some = smallest_hashes(usable, "h", trees * rows, *FEATURES).drop("h").toPandas()
    if not len(some):
        return {name: [] for name in FORESTS}
    # Structs compare by their first field, then by the others, so ties don't matter.
    found = usable.agg(*(f(F.struct(c, *(x for x in FEATURES if x != c))).alias(f"{c}_{f.__name__}")
                         for c in FEATURES for f in (F.min, F.max))).first()
    out = {}
    for name, cols in FORESTS.items():
        x = some[list(cols)].to_numpy(np.float64)
        ends = np.unique([[found[f"{c}_{f}"][k] for k in cols] for c in cols for f in ("min", "max")], axis=0)
        rng = np.random.default_rng(seed)
        picks = (rng.choice(len(x), min(rows, len(x)), replace=False) for _ in range(trees))
        out[name] = [np.array(grow_tree(np.concatenate([x[p], ends]), rng, max(1, math.ceil(math.log2(rows))))) for p in picks]
    return out


def failed():
    """The base rule."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def score(stats: DataFrame, forests: dict[str, list[np.ndarray]], rows: int = TREE_ROWS) -> DataFrame:
    """Adds each forest's score (0 to 1) to the statistics."""
    names = stats.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for name, cols in FORESTS.items():
                x = np.column_stack([b.column(c).to_numpy() for c in cols]) if b.num_rows else np.zeros((0, len(cols)))
                got.append(pa.array(anomaly(forests[name], x, rows) if forests[name] else np.zeros(len(x))))
            yield pa.RecordBatch.from_arrays([*b.columns, *got], [*names, *FORESTS])

    schema = ", ".join(f"{c} {t}" for c, t in stats.dtypes)
    return stats.mapInArrow(run, f"{schema}, {', '.join(f'{c} double' for c in FORESTS)}")


def calibrate(scored: DataFrame, labels: DataFrame, label_id: str = "doc_id", label: str = "quality") -> dict[str, float]:
    """Per forest, the threshold from which a document is rejected; 2.0 (none) without use."""
    lab = labels.select(F.col(label_id).alias("doc_id"), F.col(label).alias("good")).filter(
        F.col("good").isNotNull() & F.col("doc_id").isNotNull())
    left = cut_lineage(scored.filter(~failed()).select("doc_id", *FORESTS).join(lab, "doc_id").select("good", *FORESTS))
    cuts: dict[str, float] = {}
    bad_all = ok_all = None
    for name in FORESTS:
        hist = (left.groupBy(F.floor(F.col(name) * BINS).alias("bin"))
                .agg(F.count_if(F.col("good") == 0).alias("bad"), F.count_if(F.col("good") != 0).alias("ok")).collect())
        if bad_all is None:  # shares are of all labelled rows, also for the later forest
            bad_all, ok_all = sum(r["bad"] for r in hist), sum(r["ok"] for r in hist)
        best, cut, bad, ok = 0.0, 2.0, 0, 0
        for r in sorted(hist, key=lambda r: -r["bin"]):
            bad, ok = bad + r["bad"], ok + r["ok"]
            gain = bad / max(bad_all, 1) - GOOD_COST * ok / max(ok_all, 1)
            if gain > best:
                best, cut = gain, r["bin"] / BINS
        cuts[name] = cut
        left = left.filter(F.col(name) < cut)
    return cuts


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. The rows are judged
    where they are (statistics are counted again), so texts are not shuffled."""
    stats = cut_lineage(rule_stats(docs, id_col, text_col))
    forests = fit_forests(stats)
    cuts = calibrate(score(stats, forests), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, text_col):
            x = slice_stats(s.data, s.offsets)
            ok = (x["n_words"] >= MIN_WORDS) & (100 * x["n_repeat_words"] <= REPEAT_PERCENT * x["n_words"])
            for name, trees in forests.items():
                if trees:
                    f = np.column_stack([x[c].astype(np.float64) for c in FORESTS[name]])
                    ok &= anomaly(trees, f, TREE_ROWS) < cuts[name]
            if ok.any():
                yield s.batch.filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, the five counts, ``base_failed``, ``kept`` and
    ``anomaly`` (the greater of the forests' scores)."""
    stats = cut_lineage(rule_stats(docs, id_col, text_col))
    scored = score(stats, fit_forests(stats))
    kept = ~failed()
    for name, cut in calibrate(scored, labels).items():
        kept = kept & (F.col(name) < F.lit(cut))
    return scored.select("doc_id", *[c.split()[0] for c in STATS.split(", ")], failed().alias("base_failed"),
                         kept.alias("kept"), F.greatest(*FORESTS).alias("anomaly"))
