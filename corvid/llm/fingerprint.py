"""Document fingerprints: digests of improbable features.

Every window of ``WINDOW`` bytes of a text has an entropy. Rarity is learnt from the whole
corpus: a first pass counts the windows of all documents by entropy class, and a class
ranks by its count, the rarest first (windows of very low entropy, such as runs of one
byte, are never features). Among every ``SPAN`` neighbouring windows the one of the lowest
rank (the leftmost of equals) is elected; windows elected by at least ``VOTES`` spans are
the text's features. Features enter Bloom filters of 2048 bits, five bits each, up to
``FILTER_FEATURES`` features to a filter, then the chain goes on with another. Two
fingerprints compare filter by filter: the bit overlap of two filters, normalised so that
the overlap expected by chance is 0 and the most possible is 1; each filter of the shorter
chain takes its best partner, weighted by its features.

The edited texts of the query need each document's successor. Documents are dealt to
blocks of neighbouring ids (bounds from quantiles of the ids, at most ``MOST_BLOCKS``); a
block's first document is also sent to the block before it, so texts move once, and a task
reads its sorted rows one after the other.

A text shorter than a window, or without an elected window, has one feature: itself. The
empty text has an empty fingerprint; two empty ones are alike (1), an empty and another
are not (0). Null text: empty. Null ids sort first. Equal ids: ordered by text. An empty
table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import range_hash, slices

WINDOW = 64
SPAN = 64
VOTES = 16
FILTER_BITS = 2048
FILTER_FEATURES = 160
CLASSES = 1000           # entropy classes; 0 to 6 bits for a window of 64 bytes
LOWEST_CLASS = 100       # windows below are no features
BLOCK_ROWS = 2000
MOST_BLOCKS = 4096
SCALE = 1 << 32

_c = np.arange(WINDOW + 2, dtype=np.float64)
#: c * log2 c in whole 2**-32ths, so that running sums are exact.
_G = np.rint(np.where(_c > 0, _c * np.log2(np.maximum(_c, 1)), 0) * SCALE).astype(np.int64)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The entropy class of every window of the text. Windows slide, so a window's
    sum of c log c follows from its predecessor's by the byte that leaves and the byte
    that enters; their counts are the equal bytes among the next, or last, 63."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    ahead, behind = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        ahead[: n - lag] += same
        behind[lag:] += same
    first = int(_G[np.bincount(data[:WINDOW], minlength=256)].sum())
    m = n - WINDOW + 1
    leave = ahead[: m - 1]  # counts without the byte itself
    enter = behind[WINDOW:]
    # The byte that enters counts only what is still in the window: behind looks back 63.
    step = (_G[1:] - _G[:-1])
    total = np.empty(m, np.int64)
    total[0] = first
    total[1:] = first + np.cumsum(step[enter] - step[leave])
    entropy = np.log2(WINDOW) * SCALE - total / WINDOW
    return np.clip((entropy * (CLASSES / (np.log2(WINDOW) * SCALE))).astype(np.int64), 0, CLASSES)


def class_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Windows of all documents by entropy class (at most CLASSES + 1 rows come back)."""
    src = docs.select(F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES + 1, np.int64)
        for s in slices(batches):
            whole = np.zeros(len(s.data) + 1, np.int64)  # +1 where a text's windows begin, -1 after
            size = np.diff(s.offsets)
            some = size >= WINDOW
            np.add.at(whole, s.offsets[:-1][some], 1)
            np.add.at(whole, s.offsets[1:][some] - WINDOW + 1, -1)
            own = np.cumsum(whole) > 0
            k = entropy_classes(s.data)
            total += np.bincount(k[own[: len(k)]], minlength=CLASSES + 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["k", "n"])

    out = np.zeros(CLASSES + 1, np.int64)
    for r in src.mapInArrow(run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out


def class_ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of every class, 0 the rarest; classes below LOWEST_CLASS come after all."""
    ranks = np.full(CLASSES + 1, CLASSES + 1, np.int64)
    usable = np.arange(LOWEST_CLASS, CLASSES + 1)
    ranks[usable[np.lexsort((usable, counts[usable]))]] = np.arange(len(usable))
    return ranks


def features(data: np.ndarray, ranks: np.ndarray, rank: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of a text's features, in order, each once; ``rank``: its windows'."""
    if not len(data):
        return np.zeros(0, np.uint64)
    rank = ranks[entropy_classes(data)] if rank is None else rank
    chosen = np.zeros(0, np.int64)
    if len(rank):
        key = (rank << 40) | np.arange(len(rank))
        span, width = min(SPAN, len(key)), 1
        while 2 * width <= span:
            key, width = np.minimum(key[:-width], key[width:]), 2 * width
        if width < span:
            key = np.minimum(key[: len(key) - (span - width)], key[span - width:])
        best = key[(key >> 40) <= CLASSES] & ((1 << 40) - 1)
        if len(best):
            change = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
            votes = np.diff(np.append(change, len(best)))
            chosen = best[change[votes >= min(VOTES, len(best))]]
    if not len(chosen):
        return range_hash(data, np.zeros(1, np.int64), np.full(1, len(data)))
    h = range_hash(data, chosen, chosen + WINDOW)
    _, first = np.unique(h, return_index=True)
    return h[np.sort(first)]


def bloom_chain(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chained filters, (filters, bits) of 0 and 1, and the features in each."""
    n = -(-len(h) // FILTER_FEATURES)
    bits = np.zeros((n, FILTER_BITS), np.uint8)
    of = np.arange(len(h)) // FILTER_FEATURES
    for k in range(5):
        bits[of, ((h >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    return bits, np.bincount(of, minlength=n)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 to 1; symmetric. Chains are compared a block of filters at a time."""
    if len(a[0]) > len(b[0]) or (len(a[0]) == len(b[0]) and a[0].tobytes() > b[0].tobytes()):
        a, b = b, a
    if not len(a[0]):
        return 1.0 if not len(b[0]) else 0.0
    on_b = b[0].sum(1, dtype=np.float32)[None, :]
    best = []
    fb = b[0].T.astype(np.float32)
    for i in range(0, len(a[0]), 64):
        fa = a[0][i: i + 64].astype(np.float32)
        on_a = fa.sum(1)[:, None]
        most, chance = np.minimum(on_a, on_b), on_a * on_b / FILTER_BITS
        best.append(np.clip((fa @ fb - chance) / np.maximum(most - chance, 1e-6), 0, 1).max(1))
    return float(min(1.0, np.average(np.concatenate(best).astype(np.float64), weights=a[1])))


def to_text(chain: tuple[np.ndarray, np.ndarray]) -> str:
    """A fingerprint as a string: features per filter, then the filters in Base64."""
    bits, n = chain
    return ":".join([",".join(map(str, n.tolist())), base64.b64encode(np.packbits(bits, axis=1).tobytes()).decode()])


def from_text(text: str) -> tuple[np.ndarray, np.ndarray]:
    n, raw = text.split(":")
    bits = np.unpackbits(np.frombuffer(base64.b64decode(raw), np.uint8)).reshape(-1, FILTER_BITS)
    return bits, np.array([int(x) for x in n.split(",") if x], np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 ranks: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, fingerprint)``, one row per input row; ``ranks`` from another corpus or
    learnt from this one."""
    ranks = class_ranks(class_counts(docs, text_col)) if ranks is None else ranks
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            fp = [to_text(d) for d in _digests([s.text(i) for i in range(len(s))], ranks)]
            yield pa.RecordBatch.from_arrays([s.batch.column("doc_id"), pa.array(fp, pa.string())],
                                             ["doc_id", "fingerprint"])

    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, fingerprint string")


# ------------------------------------------------------------- edited texts, successors


def in_blocks(src: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of ``(doc_id, text)`` with ``block`` and ``borrowed``, whole blocks to a task,
    sorted by block, id and text. After a block's own rows come the first rows of the
    next block (after the last block: of the first), marked ``borrowed``."""
    x = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0e308))
    ids = src.select(x.alias("x"))
    parts = min(MOST_BLOCKS, max(1, ids.count() // block_rows))
    bounds = ids.approxQuantile("x", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    rows = src.withColumn("x", x)
    if len(splits) > 2:
        rows = Bucketizer(splits=splits, inputCol="x", outputCol="b", handleInvalid="keep").transform(rows)
    rows = rows.select("doc_id", "text", "x", (F.col("b") if len(splits) > 2 else F.lit(0)).cast("int").alias("block"))
    # At most MOST_BLOCKS rows: the least id of every block and the block before it.
    low = [(r["block"], r["low"]) for r in rows.groupBy("block").agg(F.min("x").alias("low")).orderBy("block").collect()]
    lend = src.sparkSession.createDataFrame(
        [(b, v, low[i - 1][0]) for i, (b, v) in enumerate(low)], "lender int, low double, to_block int")
    met = rows.join(F.broadcast(lend), F.col("block") == F.col("lender"))
    place = lambda b, borrowed: F.struct(b.alias("block"), F.lit(borrowed).alias("borrowed"))
    places = F.when(F.col("x") == F.col("low"), F.array(place(F.col("block"), False), place(F.col("to_block"), True))
                    ).otherwise(F.array(place(F.col("block"), False)))
    spread = met.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.block", "p.borrowed")
    return spread.repartition("block").sortWithinPartitions("block", "borrowed", F.col("doc_id").asc_nulls_first(), "text")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _digests(texts: list[bytes], ranks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Digests of a bounded list of texts; their windows are classed in one go."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    rank = ranks[entropy_classes(data)]
    out, at = [], 0
    for t in texts:
        out.append(bloom_chain(features(data[at: at + len(t)], ranks, rank[at: max(at, at + len(t) - WINDOW + 1)])))
        at += len(t)
    return out


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      ranks: np.ndarray | None = None) -> DataFrame:
    """One row per input row: ``(doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next)``. Ids are numbers."""
    ranks = class_ranks(class_counts(docs, text_col)) if ranks is None else ranks
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = in_blocks(docs.select(F.col(id_col).alias("doc_id"), text.alias("text")))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row of the slice before: (id, text), with its digest
        for s in slices(batches):
            raw = [s.text(i) for i in range(len(s))]
            own = [not b for b in s.batch.column("borrowed").to_pylist()]
            ids = s.batch.column("doc_id").to_pylist()
            rows = [(i, r.decode("utf-8"), o) for i, r, o in zip(ids, raw, own)]
            if held:
                rows.insert(0, held[0])
            changed = [edited(a[1], b[1]) if a[2] else "" for a, b in zip(rows, rows[1:])]
            bytes_ = [c.encode("utf-8") for c in changed]
            got = _digests(raw + bytes_, ranks)
            plain, other = ([held[1]] if held else []) + got[: len(raw)], got[len(raw):]
            out = [(a[0], len(a[1]), hashlib.sha256(b).hexdigest(), to_text(p), to_text(e), likeness(p, e), likeness(p, q))
                   for a, b, p, q, e in zip(rows, bytes_, plain, plain[1:], other) if a[2]]
            held = (rows[-1], plain[-1])
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], s.batch.column("doc_id").type), pa.array(cols[1], pa.int64()),
                     *(pa.array(c, pa.string()) for c in cols[2:5]), *(pa.array(c, pa.float64()) for c in cols[5:])], names)

    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, n_chars bigint, edited_sha256 string, "
                               "fingerprint string, edited_fingerprint string, near_edited double, near_next double")
