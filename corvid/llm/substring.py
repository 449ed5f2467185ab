"""Substring dedup by recompression: words inside a window of ``WINDOW`` consecutive words
that also starts in a document with a smaller id are removed.

Recompression shortens every text round by round: a run of one symbol gets one name, then
every pair "left symbol, right symbol" gets one name, where a fair coin per symbol and
round says left or right. Names are hashes of what they stand for, so a name means the
same in every task without a lookup, and equal substrings get the same symbols except
near their two ends. How far the ends reach follows from a window's own words: at the
left end a round spoils the first run, and the next symbol if its coin is "right" (an
unseen left neighbour may take it); the right end is the mirror image. What is left are
the window's interior symbols, the same in every occurrence of the window.

Spark rounds:

0. Exact copies are settled by their content hashes: a text that a smaller id has whole
   loses every word (if it has a window at all), and one document of each group goes on.
1. Every window's *key symbols* are the least of its interior groups of ``GROUP``
   neighbouring symbols. Distinct (key, document) pairs are counted; a key met in one
   document only rules its windows out. The shared keys become a Bloom filter of bounded
   size (``FILTER_BYTES``); false positives only send more windows on.
2. Windows with a shared key, and the few without interior symbols (long runs of one
   word), are verified: 95 bits of their word hashes are grouped and the smallest id of each
   is joined back. Both joins split hot keys (a passage in a third of the documents)
   adaptively; the grouping combines before the exchange.
3. The covered stretches of each document are joined to its text and cut out.

Nothing is dropped or capped: every window is either ruled out by a key that no other
document has or compared. Null id: the document is never a source and loses nothing. Null
or empty text: no words. Rows with one id and different texts are separate documents (none
is smaller than the other). Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import Slice, mix, range_hash, slices, tokens, words_of
from corvid.session import cut_lineage

WINDOW = 50
ROUNDS = 4
GROUP = 3
FILTER_BYTES = 32 << 20
FILTER_PROBES = 4
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def name(*parts: np.ndarray) -> np.ndarray:
    """The name of a tuple of symbols and numbers."""
    h = np.full(len(parts[0]), 0x243F6A8885A308D3, np.uint64)
    for p in parts:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + p.astype(np.uint64))
    return h


def name_runs(symbols: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs named: the new symbols, and each old symbol's new place. A run of one
    keeps its name."""
    new = np.ones(len(symbols), bool)
    new[1:] = symbols[1:] != symbols[:-1]
    heads = np.flatnonzero(new)
    length = np.diff(np.append(heads, len(symbols)))
    out = symbols[heads]
    long = np.flatnonzero(length > 1)
    out[long] = name(out[long], length[long], np.full(len(long), 2 * level))
    return out, np.cumsum(new) - 1


def name_pairs(symbols: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a left and a right symbol named: the new symbols, each old symbol's new
    place, and which old symbols are right ones."""
    right = (mix(symbols + np.uint64(level)) & np.uint64(1)).astype(bool)
    second = np.zeros(len(symbols), bool)
    second[1:] = right[1:] & ~right[:-1]
    out = symbols[~second]
    place = np.cumsum(~second) - 1
    b = np.flatnonzero(second)
    out[place[b]] = name(symbols[b - 1], symbols[b], np.full(len(b), 2 * level + 1))
    return out, place, right


def interior(symbols: np.ndarray, first: np.ndarray, last: np.ndarray,
             rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols after ``rounds`` rounds, and for each range [first, last) of the input
    its interior range of them (empty where the ends meet)."""
    p, q = first.astype(np.int64), last.astype(np.int64)
    for level in range(1, rounds + 1):
        if not len(symbols):
            break
        live = p < q
        symbols, run = name_runs(symbols, level)
        at = len(run) - 1
        p, q = np.where(live, run[np.minimum(p, at)] + 1, 0), np.where(live, run[np.clip(q - 1, 0, at)], 0)
        live = p < q
        symbols, place, right = name_pairs(symbols, level)
        at = len(place) - 1
        p = p + (live & right[np.minimum(p, at)])
        q = q - (live & ~right[np.clip(q - 1, 0, at)])
        live = p < q
        p, q = np.where(live, place[np.minimum(p, at)], 0), np.where(live, place[np.clip(q - 1, 0, at)] + 1, 0)
    return symbols, p, q


def range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value of each range [first, last); NONE for an empty one."""
    out = np.full(len(first), NONE)
    size = last - first
    table, width = values, 1
    while len(table) and (size >= width).any():
        sel = np.flatnonzero((size >= width) & (size < 2 * width))
        out[sel] = np.minimum(table[first[sel]], table[last[sel] - width])
        table, width = np.minimum(table[:-width], table[width:]) if len(table) > width else table[:0], 2 * width
    return out


def window_keys(word_hash: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The key of each window that begins at a word of ``starts``; NONE without one."""
    symbols, p, q = interior(word_hash, starts, starts + window)
    if len(symbols) < GROUP:
        return np.full(len(starts), NONE)
    groups = name(*(symbols[i: len(symbols) - GROUP + 1 + i] for i in range(GROUP)))
    groups[groups == NONE] = np.uint64(0)
    return range_min(groups, p, np.maximum(q - GROUP + 1, p))


def _windows(s, window: int):
    """Word hashes of a slice, where its windows start, and each one's text."""
    t = tokens(s.data, s.offsets)
    h = range_hash(s.data, t.starts, t.ends)
    n = np.maximum(t.counts - window + 1, 0)
    doc = np.repeat(np.arange(len(s)), n)
    pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return t, h, t.first[:-1][doc] + pos, doc, pos


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row_hash"))


def _has(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys a filter has (or seems to have)."""
    place = _bits(key, len(bits) * 8)
    return ((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).all(axis=0)


def _texts(batches: Iterator[pa.RecordBatch], copied: bytes | None, inside: bool = False) -> Iterator[Slice]:
    """Slices of the rows whose content hash is not in the filter ``copied`` (``inside``:
    is in it); all rows without a filter."""
    bits = None if copied is None else np.frombuffer(copied, np.uint8)
    for b in batches:
        if bits is not None and b.num_rows:
            b = b.filter(pa.array(_has(bits, b.column("row_hash").to_numpy().view(np.uint64)) == inside))
        yield from slices([b])


def copies(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> tuple[bytes, DataFrame, DataFrame]:
    """Round 0: a filter of the contents that several ids have; of each such content the
    document with the smallest id; and ``(doc_id, row_hash)`` of its other documents."""
    content = docs.select("doc_id", "row_hash", F.xxhash64(F.lit(1), F.col("text")).alias("more"))
    copied = shared_key_filter(content.select(F.col("row_hash").alias("key"), "doc_id"), filter_bytes).tobytes()
    sent = docs.sparkSession.sparkContext.broadcast(copied)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _texts(batches, sent.value, inside=True):
            yield s.batch.select(["doc_id", "text", "row_hash"])

    some = docs.mapInArrow(run, docs.schema).withColumn("more", F.xxhash64(F.lit(1), F.col("text")))
    first = some.groupBy("row_hash", "more").agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))
    low = cut_lineage(content.groupBy("row_hash", "more").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                      .filter(F.col("low") < F.col("high")))  # a content per row, written as in repeated_windows
    others = content.join(low, ["row_hash", "more"]).filter(F.col("doc_id") > F.col("low"))
    return copied, cut_lineage(first.select("doc_id", "text", "row_hash")), others.select("doc_id", "row_hash").distinct()


def key_documents(docs: DataFrame, copied: bytes | None = None, window: int = WINDOW) -> DataFrame:
    """Round 1: ``(key, doc_id)`` of all windows; copies (texts in the
    filter ``copied``) are left out."""
    sent = docs.sparkSession.sparkContext.broadcast(copied)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _texts(batches, sent.value):
            _, h, at, doc, _ = _windows(s, window)
            key = window_keys(h, at, window)
            change = np.ones(len(key), bool)  # neighbouring windows mostly share theirs
            change[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            keep = np.flatnonzero(change & (key != NONE))
            yield pa.RecordBatch.from_arrays([pa.array(key[keep].view(np.int64)),
                                              s.batch.column("doc_id").take(pa.array(doc[keep]))], ["key", "doc_id"])

    return docs.mapInArrow(run, f"key bigint, doc_id {dict(docs.dtypes)['doc_id']}")


def _bits(key: np.ndarray, size: int) -> np.ndarray:
    """Bit places of every key, (probes, keys)."""
    second = mix(key) | np.uint64(1)
    return np.stack([(mix(key + np.uint64(i) * second) % np.uint64(size)).astype(np.int64)
                     for i in range(FILTER_PROBES)])


def shared_key_filter(pairs: DataFrame, filter_bytes: int = FILTER_BYTES) -> np.ndarray:
    """A Bloom filter (bytes) of the keys met in two documents or more. Its size follows
    their number up to ``filter_bytes``; tasks return pieces of 64 KiB that have bits."""
    shared = pairs.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter(
        F.col("low") != F.col("high")).select("key").persist()
    n = shared.count()
    size = 8 * min(filter_bytes, max(1 << 13, 1 << (2 * n).bit_length()))
    piece = min(size, 1 << 19)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size // 8, np.uint8)
        for b in batches:
            bits = _bits(b.column(0).to_numpy().view(np.uint64), size).ravel()
            np.bitwise_or.at(own, bits >> 3, np.left_shift(1, bits & 7).astype(np.uint8))
        for i in range(size // piece):
            part = own[i * piece // 8: (i + 1) * piece // 8]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([part.tobytes()])], ["i", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(raw, np.uint8)
                got[i] = got[i] | part if i in got else part
        for i, part in got.items():
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([part.tobytes()])], ["i", "bits"])

    out = np.zeros(size // 8, np.uint8)
    made = shared.mapInArrow(run, "i bigint, bits binary").repartition("i").mapInArrow(merge, "i bigint, bits binary")
    for r in made.toLocalIterator():
        out[r["i"] * piece // 8: (r["i"] + 1) * piece // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    shared.unpersist()
    return out


def candidate_windows(docs: DataFrame, shared: np.ndarray, copied: bytes | None = None, window: int = WINDOW) -> DataFrame:
    """Round 2: ``(h1, h2, doc_id, row_hash, pos)`` of the windows with a shared key or
    without a key, copies left out."""
    sent = docs.sparkSession.sparkContext.broadcast((shared.tobytes(), copied))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value[0], np.uint8)
        for s in _texts(batches, sent.value[1]):
            _, h, at, doc, pos = _windows(s, window)
            key = window_keys(h, at, window)
            some, back = np.unique(key, return_inverse=True)
            hit = (_has(bits, some) | (some == NONE))[back]
            keep = np.flatnonzero(hit)
            start = at[keep]
            h1 = range_hash(h, start, start + window)
            h2 = range_hash(mix(h ^ np.uint64(0xA0761D6478BD642F)), start, start + window)
            rows = pa.array(doc[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1.view(np.int64)), pa.array((h2 >> np.uint64(33)).astype(np.int32)), s.batch.column("doc_id").take(rows),
                 s.batch.column("row_hash").take(rows), pa.array(pos[keep].astype(np.int32))],
                ["h1", "h2", "doc_id", "row_hash", "pos"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"h1 bigint, h2 int, doc_id {kind}, row_hash bigint, pos int")


def repeated_windows(cand: DataFrame) -> DataFrame:
    """Round 2, verified: ``(doc_id, row_hash, pos)`` of the windows that a smaller id has.
    The smallest ids are written out first: both sides of the join are then plain
    exchanges, so the rows of a hot window can be split over tasks."""
    low = cut_lineage(cand.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter(
        F.col("low") < F.col("high")).select("h1", "h2", "low"))
    return cand.join(low, ["h1", "h2"]).filter(F.col("doc_id") > F.col("low")).select("doc_id", "row_hash", "pos")


def cut_positions(gone: DataFrame) -> DataFrame:
    """``(doc_id, row_hash, cuts)``: the places of a row's windows that go. Equal rows report a
    window several times; a set holds it once, before the exchange too, so ``cuts`` is no longer
    than its text however often the row is repeated."""
    return gone.groupBy("doc_id", "row_hash").agg(F.collect_set("pos").alias("cuts"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
          filter_bytes: int = FILTER_BYTES, with_text: bool = False) -> DataFrame:
    """One row per input row: ``(doc_id, n_words, n_removed, kept_sha256)``; the kept words
    are joined by one space. ``with_text`` adds ``kept_text``, the text unchanged if it
    lost nothing, else the kept words joined, and ``row``, the input row as a struct."""
    src = _source(docs, id_col, text_col)
    known = src.filter(F.col("doc_id").isNotNull())
    copied, firsts, others = copies(known, filter_bytes)
    keys = key_documents(known, copied, window).unionByName(key_documents(firsts, None, window))
    shared = shared_key_filter(keys, filter_bytes)
    cand = candidate_windows(known, shared, copied, window).unionByName(candidate_windows(firsts, shared, None, window))
    gone = cut_positions(repeated_windows(cand))
    every = F.lit(None).cast("array<int>")
    cuts = gone.withColumn("copy", F.lit(False)).unionByName(others.withColumn("cuts", every).withColumn("copy", F.lit(True)))
    whole = src if not with_text else docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("row")).withColumn("row_hash", F.xxhash64("text"))
    met = whole.join(cuts, ["doc_id", "row_hash"], "left").drop("row_hash")
    kind, row = dict(src.dtypes)["doc_id"], dict(whole.dtypes).get("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            out: list[tuple] = []
            for i, (cut, copy) in enumerate(zip(s.batch.column("cuts"), s.batch.column("copy").to_pylist())):
                text = s.text(i)
                words = words_of(text)
                n, kept = len(words), words
                if copy:
                    kept = [] if n >= window else words
                elif cut.is_valid:
                    edge = np.zeros(n + 1, np.int64)
                    starts = cut.values.to_numpy()
                    edge[starts] += 1
                    edge[starts + window] -= 1
                    kept = list(itertools.compress(words, (np.cumsum(edge[:n]) == 0).tolist()))
                joined = b" ".join(kept)
                out.append((n, n - len(kept), hashlib.sha256(joined).hexdigest(),
                            (text if len(kept) == n else joined) if with_text else b""))
            n, removed, digest, left = zip(*out)
            cols = [s.batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols += [pa.array([x.decode("utf-8") for x in left], pa.string()), s.batch.column("row")]
                names += ["kept_text", "row"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return met.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
                               + (f", kept_text string, row {row}" if with_text else ""))


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None,
                  window: int = WINDOW) -> DataFrame:
    """``docs`` with what :func:`dedup` leaves of each text, all columns in their order;
    rows that lost every word go. ``size_col`` is set to the new number of characters."""
    out = dedup(docs, id_col, text_col, window, with_text=True)
    out = out.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    kinds = dict(docs.dtypes)
    return out.select(*[
        F.col("kept_text").alias(c) if c == text_col else
        F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row")[c]).cast(kinds[c]).alias(c)
        if c == size_col else F.col("row")[c].alias(c) for c in docs.columns])
