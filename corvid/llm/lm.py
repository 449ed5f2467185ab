"""Language-model scores from a log-frequency Bloom filter.

Tokens: A-Z lower-cased words, then one end token per text. Training counts words and word
pairs (the first pair begins with a begin mark). A count c is quantised to
``q = 1 + floor(log c / log BASE)`` and the filter holds the keys (n-gram, 1) ... (n-gram,
q); a reader probes them one by one until one is missing, which gives the quantised count
back (now and then a little more, never less). The filter is cut into segments by the
n-gram's hash, so each task builds whole segments and only finished bytes reach the
driver; they are broadcast to the scoring tasks. Its size follows the corpus (about
``BITS_PER_KEY`` bits per key) up to ``MAX_FILTER_BYTES`` in all. A segment beyond its share
holds the pairs from the least count on that makes it fit, and where its words alone are too
many, the words from the least count on that makes them fit. So the broadcast is bounded and
no segment is overfull; the other pairs and words stay in a table, and tokens whose pair, word
or previous word may be among them are joined to it by the hash. A score so depends on no
filter's size, but for the filter's false positives.

P(w | v) = s * min(c(v,w), c(v)) / c(v) + (1 - s) * P(w), with s = ``PAIR_SHARE`` (0 where
c(v) is 0), P(w) = (c(w) + 1/2) / (N + (V + 1) / 2), and all c read from the filter or the
table, quantised alike.

The base score needs every token's exact count. Words frequent enough to be among about
``HEAD`` are broadcast (their number is known from a histogram of all counts before); the
others are joined by their hash, so a frequent word is never a join key, and nothing that
grows with the vocabulary is held in one place. Words are identified by 64-bit hashes.

Null text: empty (one end token). Null id: its text is ``''`` for the split. Repeated rows
each get a row. No training rows: N = V = 0 and every probability is one; an empty table
gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import Slice, lower, mix, range_hash, slices, tokens
from corvid.session import cut_lineage

BASE = 1.4
LEVELS = 80
BITS_PER_KEY = 8
PROBES = 5
MAX_FILTER_BYTES = 256 << 20
HEAD = 1 << 20
PAIR_SHARE = 0.3       # weight of the pair's own frequency in a token's probability
PAIR_ROWS = 1 << 20    # pairs that are not in the filter, in a row of the trained table
IS_TEXT, IS_WORD, IS_PAIR = 0, 1, 2
IS_OWN, IS_PREVIOUS = 3, 4   # a late token's word and previous word; both are looked up as IS_OWN
SEGMENT_ROWS = 2048      # texts whose counts make a segment, about
LEAST_SEGMENTS = 64
PENDING = 1_000_000   # counts that a training task holds before it merges or sends them

END, BEGIN = np.uint64(0xE17BA1156E53F5C1), np.uint64(0xB5297A4D3F84D5A9)


def is_held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def token_hashes(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice's texts, each text's end token included, and each text's
    first token (one more at the end)."""
    data = lower(s.data)
    t = tokens(data, s.offsets)
    first = t.first + np.arange(len(s) + 1)
    h = np.full(int(first[-1]), END)
    inner = np.ones(len(h), bool)
    inner[first[1:] - 1] = False
    h[inner] = range_hash(data, t.starts, t.ends)
    return h, first


def previous(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    v = np.empty_like(h)
    v[1:] = h[:-1]
    v[first[:-1]] = BEGIN
    return v


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * np.uint64(0x9E3779B97F4A7C15) + mix(w))


def merged(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h, c = h[order], c[order]
    heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[heads], np.add.reduceat(c, heads) if len(h) else c


def pack(h: np.ndarray, c: np.ndarray) -> bytes:
    """Sorted hashes as byte planes of their differences, then counts as byte planes: the
    high planes are zero and vanish in the shuffle's compression."""
    gap = np.diff(h, prepend=np.uint64(0))
    planes = lambda x: np.ascontiguousarray(x.view(np.uint8).reshape(len(x), 8).T).tobytes()
    return planes(gap) + planes(c.astype(np.uint64))


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(2, 8, -1).transpose(0, 2, 1))
    both = x.view(np.uint64)[:, :, 0]
    return np.cumsum(both[0], dtype=np.uint64), both[1].astype(np.int64)


def quantised(c: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log(np.maximum(c, 1)) / np.log(BASE) + 1e-9).astype(np.int64), LEVELS)


def level_counts() -> np.ndarray:
    """The count that a quantised count stands for: the middle of its whole numbers."""
    q = np.arange(LEVELS + 2, dtype=np.float64)
    low, high = np.ceil(BASE ** (q - 1) - 1e-9), np.ceil(BASE ** q - 1e-9) - 1
    out = np.where(low <= high, (low + high) / 2, BASE ** (q - 0.5))
    out[0] = 0.0
    return out


def _salt(level: int) -> np.uint64:
    return np.uint64(0xA24BAED4963EE407 * level % (1 << 64))


def _places(h: np.ndarray, level: int, size: np.ndarray | int) -> Iterator[np.ndarray]:
    """Bit places of the keys (h, level) in segments of ``size`` bits, probe by probe."""
    g = mix(h + _salt(level))
    step = mix(g) | np.uint64(1)
    for i in range(PROBES):
        yield (mix(g + np.uint64(i) * step) % np.asarray(size, np.uint64)).astype(np.int64)


def segment_bits(q: np.ndarray) -> int:
    return max(64, -(-int(q.sum()) * BITS_PER_KEY // 64) * 64)


def least_word(c: np.ndarray, most_bytes: int) -> int:
    """The least count of the words in a segment, which rises until their keys fit."""
    least = 1
    while segment_bits(quantised(c[c >= least])) > max(64, 8 * most_bytes):
        least *= 2
    return least


def build_segment(words: tuple, pairs: tuple, most_bytes: int) -> tuple[bytes, int]:
    """The bytes of one segment, and the least count of the pairs in it, which rises until
    the keys fit. The words must fit (:func:`least_word`)."""
    (wh, wc), (ph, pc) = words, pairs
    least = 1
    while True:
        keep = pc >= least
        h, q = np.concatenate([wh, ph[keep]]), quantised(np.concatenate([wc, pc[keep]]))
        size = segment_bits(q)
        if size <= 8 * most_bytes or not keep.any():
            break
        least *= 2
    size = min(size, max(64, 8 * most_bytes))
    bits = np.zeros(size, np.uint8)
    for level in range(1, int(q.max(initial=0)) + 1):
        for place in _places(h[q >= level], level, size):
            bits[place] = 1
    return np.packbits(bits, bitorder="little").tobytes(), least


@dataclass
class Model:
    """What scoring tasks get: the filter's segments, and exact counts of frequent words."""

    bits: list[bytes]        # of each segment
    pair_least: np.ndarray   # of each segment: the least count of the pairs in it
    n_tokens: int
    n_types: int
    n_texts: int
    head_hash: np.ndarray
    head_count: np.ndarray
    word_least: np.ndarray | None = None   # of each segment: the least count of the words in it

    def open(self) -> None:
        """Joins the segments, once per worker."""
        if not hasattr(self, "raw"):
            self.starts = np.concatenate([[0], np.cumsum([len(p) for p in self.bits])])
            self.raw = np.frombuffer(b"".join(self.bits), np.uint8)
            self.bits = [b""] * len(self.bits)

    def segment(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - len(self.bits).bit_length() + 1)).astype(np.int64)

    def outside(self, h: np.ndarray, c: np.ndarray, least: np.ndarray | None = None) -> np.ndarray:
        """Which pairs (or with ``least``: words), read as ``c``, can't be in their segment:
        it holds larger counts only."""
        least = self.pair_least if least is None else least
        return c < np.where(least > 1, level_counts()[quantised(least)], 0)[self.segment(h)]

    def words_outside(self, words: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.zeros(len(words), bool) if self.word_least is None else self.outside(words, c, self.word_least)

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Counts read from the filter."""
        self.open()
        raw = self.raw
        seg = self.segment(h)
        begin, size = self.starts[seg], (self.starts[seg + 1] - self.starts[seg]) * 8
        q = np.zeros(len(h), np.int64)
        live = np.arange(len(h))
        for level in range(1, LEVELS + 1):
            hit = live
            g = mix(h[hit] + _salt(level))
            step = mix(g) | np.uint64(1)
            for i in range(PROBES):
                place = (mix(g + np.uint64(i) * step) % size[hit].astype(np.uint64)).astype(np.int64)
                on = (raw[begin[hit] + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 == 1
                hit, g, step = hit[on], g[on], step[on]
            live = hit
            if not len(live):
                break
            q[live] = level
        return level_counts()[q]


def train(docs: DataFrame, segments: int, filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Per segment: ``(segment, bits, words, n_tokens, n_types, n_texts, histogram, least, word_least)``;
    ``words`` holds the exact word counts, also of words with less than ``word_least``, which
    are not in the segment. Rows without ``bits`` hold the counts of pairs that are not in
    their segment as ``pairs``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {1: [], 2: []}

        def send(order: int) -> pa.RecordBatch:
            (h, c), = held[order]
            held[order] = []
            cut = np.searchsorted(h >> np.uint64(64 - segments.bit_length() + 1), np.arange(segments + 1))
            some = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), order, np.int32)),
                 pa.array([pack(h[cut[i]: cut[i + 1]], c[cut[i]: cut[i + 1]]) for i in some], pa.binary())],
                ["segment", "size", "counts"])

        def merge(order: int) -> int:
            held[order] = [merged(np.concatenate([h for h, _ in held[order]]), np.concatenate([c for _, c in held[order]]))]
            return len(held[order][0][0])

        def one(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return merged(h, np.ones(len(h), np.int64))

        for s in slices(batches):
            h, first = token_hashes(s)
            for order, x in ((1, h), (2, pair_hash(previous(h, first), h))):
                held[order].append(one(x))
                if sum(len(p[0]) for p in held[order]) > PENDING * 2 and merge(order) > PENDING:
                    yield send(order)
        for order in (1, 2):
            if held[order]:
                merge(order)
                yield send(order)
        pa.default_memory_pool().release_unused()

    kinds = {"bits": pa.binary(), "words": pa.binary(), "n_tokens": pa.int64(), "n_types": pa.int64(), "n_texts": pa.int64(),
             "histogram": pa.list_(pa.int64()), "least": pa.int64(), "word_least": pa.int64(), "pairs": pa.binary()}

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {1: [], 2: []}
        now = None

        def done() -> Iterator[pa.RecordBatch]:
            (wh, wc), (ph, pc) = (merged(np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in held[k])]),
                                         np.concatenate([np.zeros(0, np.int64), *(c for _, c in held[k])])) for k in (1, 2))
            hist = np.bincount(np.log2(np.maximum(wc, 1)).astype(np.int64), minlength=64)
            word_least = least_word(wc, filter_bytes // segments)
            fit = wc >= word_least
            bits, least = build_segment((wh[fit], wc[fit]), (ph, pc), filter_bytes // segments)
            yield row(bits=bits, words=pack(wh, wc), n_tokens=int(wc.sum()), n_types=len(wh),
                      n_texts=int(wc[wh == END].sum()), histogram=hist.tolist(), least=least, word_least=word_least)
            ph, pc = ph[pc < least], pc[pc < least]
            for i in range(0, len(ph), PAIR_ROWS):
                yield row(pairs=pack(ph[i: i + PAIR_ROWS], pc[i: i + PAIR_ROWS]))

        def row(**values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), *(pa.array([values.get(c)], t) for c, t in kinds.items())], ["segment", *kinds])

        for b in batches:
            for seg, size, cell in zip(b.column("segment").to_pylist(), b.column("size").to_pylist(), b.column("counts")):
                if now is not None and seg != now:
                    yield from done()
                    held = {1: [], 2: []}
                now = seg
                held[size].append(unpack(cell.as_buffer()))  # a view: the batch may hold a whole partition
        if now is not None:
            yield from done()
        held.clear()
        pa.default_memory_pool().release_unused()

    counted = docs.mapInArrow(count, "segment int, size int, counts binary")
    return counted.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        finish, "segment int, bits binary, words binary, n_tokens bigint, n_types bigint, n_texts bigint, "
                "histogram array<bigint>, least bigint, word_least bigint, pairs binary")


def segment_count(docs: DataFrame, filter_bytes: int = MAX_FILTER_BYTES) -> int:
    """Filter segments for the texts to learn from: a power of two, about one per
    ``SEGMENT_ROWS`` texts, so that a segment's counts fit a task as the corpus grows, and
    none smaller than 64 bytes. It depends on the table only, not on partitions or settings,
    so equal tables give equal filters and equal scores. Texts are counted, not measured: the
    count reads no text, and a segment's share grows with the mean length of a text only."""
    most = max(LEAST_SEGMENTS, 1 << (max(filter_bytes // 64, 1).bit_length() - 1))
    return min(most, max(LEAST_SEGMENTS, 1 << (-(-docs.count() // SEGMENT_ROWS) - 1).bit_length()))


def rest_counts(trained: DataFrame, below: int) -> DataFrame:
    """``(look, h, c)``: the exact counts of words with less than ``below``, and the
    quantised ones of the pairs (IS_PAIR) and words (IS_OWN) that are not in the filter."""
    def rows(look: int, h: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(h), look, np.int32)), pa.array(h.view(np.int64)), pa.array(c.astype(np.float64))],
            ["look", "h", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, pairs, word_least in zip(*(b.column(k).to_pylist() for k in range(3))):
                h, c = unpack(words if pairs is None else pairs)
                if pairs is not None:
                    yield rows(IS_PAIR, h, level_counts()[quantised(c)])
                    continue
                yield rows(IS_WORD, h[c < below], c[c < below])
                if word_least > 1:
                    out = c < word_least
                    yield rows(IS_OWN, h[out], level_counts()[quantised(c[out])])

    return trained.select("words", "pairs", "word_least").mapInArrow(run, "look int, h bigint, c double")


def frequent_words(trained: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the words with c >= least, sent as packed bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for seg, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h, c = unpack(raw)
                yield pa.RecordBatch.from_arrays([pa.array([seg], pa.int32()), pa.array([pack(h[c >= least], c[c >= least])])],
                                                 ["segment", "words"])

    got = trained.filter(F.col("bits").isNotNull()).select("segment", "words").mapInArrow(run, "segment int, words binary").toLocalIterator()
    parts = [unpack(bytes(r["words"])) for r in sorted(got, key=lambda r: r["segment"])]
    return (np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in parts)]),
            np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)]))


def load_model(trained: DataFrame, segments: int, head: int = HEAD) -> tuple[Model, int]:
    """The model, and the least count of its frequent words. The driver holds the filter
    (bounded by MAX_FILTER_BYTES), piece by piece, and at most ``head`` words."""
    parts, totals, hist = [bytes(8)] * segments, np.zeros(3, np.int64), np.zeros(64, np.int64)
    pair_least, word_least = np.ones(segments, np.int64), np.ones(segments, np.int64)
    for r in trained.filter(F.col("bits").isNotNull()).drop("words", "pairs").toLocalIterator():
        parts[r["segment"]], pair_least[r["segment"]] = bytes(r["bits"]), r["least"]
        word_least[r["segment"]] = r["word_least"]
        totals += [r["n_tokens"], r["n_types"], r["n_texts"]]
        hist += r["histogram"]
    above = np.cumsum(hist[::-1])[::-1]
    least = 1 << int(np.argmax(above <= head)) if (above <= head).any() else 1 << 62
    return Model(parts, pair_least, *totals.tolist(), *frequent_words(trained, least),
                 word_least if word_least.max() > 1 else None), least


def grouped(some: np.ndarray, doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the tokens ``some``: one for each (text, value), and how many there are."""
    some = some[np.lexsort((value[some], doc[some]))]
    d, v = doc[some], value[some]
    heads = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])])) if len(d) else np.zeros(0, np.int64)
    return some[heads], np.diff(np.append(heads, len(d)))


def score_slice(m: Model, s: Slice) -> tuple[np.ndarray, ...]:
    """Per text: tokens, frequent known tokens, their base score, the model's score; then
    the other words as (text, hash, times); then the tokens whose pair is not in the filter
    as (text, hash, times, count of the first word, P(w)), which the score leaves out; then
    the late tokens, whose word or previous word is not in the filter, as (text, pair, times,
    count of the first word, P(w), count of the pair if it is in the filter, word, whether to
    look it up, previous word, whether to look it up), which the score leaves out too."""
    h, first = token_hashes(s)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(s)), n)
    words, word = np.unique(h, return_inverse=True)
    v = previous(h, first)
    pairs, pair = np.unique(pair_hash(v, h), return_inverse=True)
    of_word, of_pair = m.counts(words), m.counts(pairs)
    c1, c2 = of_word[word], of_pair[pair]
    cv = np.empty_like(c1)
    cv[1:] = c1[:-1]
    cv[first[:-1]] = m.n_texts
    scale = max(m.n_tokens + 0.5 * (m.n_types + 1), 0.5)
    p1 = np.minimum((c1 + 0.5) / scale, 1.0)
    p = np.where(cv > 0, PAIR_SHARE * np.minimum(c2, cv) / np.maximum(cv, 1) + (1 - PAIR_SHARE) * p1, p1)
    at = np.minimum(np.searchsorted(m.head_hash, words), max(len(m.head_hash) - 1, 0))
    in_head = m.head_hash[at] == words if len(m.head_hash) else np.zeros(len(words), bool)
    exact = np.where(in_head, m.head_count[at] if len(m.head_hash) else 0, 0)
    known = in_head[word]
    base = np.where(known, np.log10((exact[word] + 0.5) / scale), 0.0)
    add = lambda x: np.bincount(doc, weights=x, minlength=len(s))
    own = m.words_outside(words, of_word)[word]
    before = np.zeros_like(own)
    before[1:] = own[:-1]
    before[first[:-1]] = False
    late, beyond = own | before, m.outside(pairs, of_pair)
    away = beyond[pair] & (cv > 0) & ~late
    first_word, times = grouped(np.flatnonzero(~known), doc, word)
    first_pair, pair_times = grouped(np.flatnonzero(away), doc, pair)
    first_late, late_times = grouped(np.flatnonzero(late), doc, pair)
    read = np.where(beyond, np.nan, of_pair)[pair[first_late]]
    return (n, add(known).astype(np.int64), add(base), add(np.where(away | late, 0.0, np.log10(p))),
            (doc[first_word], h[first_word], times),
            (doc[first_pair], pairs[pair[first_pair]], pair_times, cv[first_pair], p1[first_pair]),
            (doc[first_late], pairs[pair[first_late]], late_times, cv[first_late], p1[first_late], read,
             h[first_late], own[first_late], v[first_late], before[first_late]))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: Column | None = None,
          head: int = HEAD, filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per input row: ``(doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score)``. ``train_rows`` marks the rows to learn from (default: those whose
    id's CRC-32 modulo 5 is not 1)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    held = is_held_out(F.col(id_col)) if train_rows is None else ~F.coalesce(train_rows, F.lit(False))
    src = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), held.alias("held_out"),
                      F.xxhash64(text).alias("row_hash"))
    segments = segment_count(src.filter(~F.col("held_out")), filter_bytes)
    trained = cut_lineage(train(src.filter(~F.col("held_out")).select("text"), segments, filter_bytes))
    model, least = load_model(trained, segments, head)
    sent = spark.sparkContext.broadcast(model)
    kind = dict(src.dtypes)["doc_id"]
    names = ["doc_id", "row_hash", "held_out", "kind", "h", "n", "known", "base", "score", "late", "read"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for s in slices(batches):
            n, known, base, sc, (d, w, times), (pd, ph, pair_times, cv, p1), late = score_slice(m, s)
            ld, lp, late_times, late_cv, late_p1, read, own, own_out, before, before_out = late
            at = pa.array(np.concatenate([np.arange(len(s)), d, pd, ld, ld[own_out], ld[before_out]]))
            sizes = [len(s), len(d), len(pd), len(ld), int(own_out.sum()), int(before_out.sum())]
            none = [np.zeros(k) for k in sizes]
            count = [x.astype(np.int64) for x in none]
            key = mix(s.batch.column("row_hash").to_numpy().view(np.uint64))  # spreads the texts' own rows
            of_late = np.concatenate([lp, lp[own_out], lp[before_out]]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [s.batch.column("doc_id").take(at), s.batch.column("row_hash").take(at), s.batch.column("held_out").take(at),
                 pa.array(np.repeat(np.array([IS_TEXT, IS_WORD, IS_PAIR, IS_PAIR, IS_OWN, IS_PREVIOUS], np.int32), sizes)),
                 pa.array(np.concatenate([key, w, ph, lp, own[own_out], before[before_out]]).view(np.int64)),
                 pa.array(np.concatenate([n, times, pair_times, late_times, *count[4:]])),
                 pa.array(np.concatenate([known, *count[1:]])),
                 # A pair's row carries the count of its first word and P(w) here.
                 pa.array(np.concatenate([base, none[1], cv, late_cv, *none[4:]])),
                 pa.array(np.concatenate([sc, none[1], p1, late_p1, *none[4:]])),
                 pa.concat_arrays([pa.nulls(sum(sizes[:3]), pa.int64()), pa.array(of_late)]),
                 pa.concat_arrays([pa.nulls(sum(sizes[:3]), pa.float64()), pa.array(read, from_pandas=True),
                                   pa.nulls(sum(sizes[4:]), pa.float64())])], names)
        pa.default_memory_pool().release_unused()

    got = src.mapInArrow(run, f"doc_id {kind}, row_hash bigint, held_out boolean, kind int, h bigint, n bigint, "
                              "known bigint, base double, score double, late bigint, read double")
    scale = float(max(model.n_tokens + 0.5 * (model.n_types + 1), 0.5))
    seen = F.coalesce(F.col("c"), F.lit(0.0))
    joined = got.withColumn("look", F.least("kind", F.lit(IS_OWN))).join(rest_counts(trained, least), ["look", "h"], "left")
    text, word, pair, own, before = (F.col("kind") == k for k in (IS_TEXT, IS_WORD, IS_PAIR, IS_OWN, IS_PREVIOUS))
    joint = PAIR_SHARE * F.least(seen, F.col("base")) / F.col("base") + (1 - PAIR_SHARE) * F.col("score")
    by, late = ["doc_id", "row_hash", "held_out"], F.col("late").isNotNull()
    sums = {"copies": text.cast("bigint"),
            "n_tokens": F.when(text, F.col("n")).otherwise(0),
            "n_known": F.when(text, F.col("known")).when(word & (seen > 0), F.col("n")).otherwise(0),
            "base_score": F.when(text, F.col("base")).when(word, F.col("n") * F.log10((seen + 0.5) / scale)).otherwise(0.0),
            "score": F.when(late, 0.0).when(pair, F.col("n") * F.log10(joint)).otherwise(F.col("score"))}
    if model.word_least is not None:
        # A late token's counts come from up to three rows: they meet by text and pair first.
        parts = joined.groupBy(*by, "late").agg(
            *(F.sum(x).alias(c) for c, x in sums.items()),
            F.sum(F.when(late & pair, F.col("n"))).alias("_times"),
            F.max(F.when(late & pair, F.coalesce("c", "read", F.lit(0.0)))).alias("_joint"),
            F.coalesce(F.max(F.when(before, seen)), F.max(F.when(late & pair, F.col("base")))).alias("_cv"),
            F.coalesce(F.max(F.when(own, F.least((seen + 0.5) / scale, F.lit(1.0)))),
                       F.max(F.when(late & pair, F.col("score")))).alias("_p1"))
        p = F.when(F.col("_cv") > 0, PAIR_SHARE * F.least("_joint", "_cv") / F.col("_cv") + (1 - PAIR_SHARE) * F.col("_p1")
                   ).otherwise(F.col("_p1"))
        joined = parts.withColumn("score", F.when(late, F.col("_times") * F.log10(p)).otherwise(F.col("score")))
        sums = {c: F.col(c) for c in sums}
    total = joined.groupBy(*by).agg(*(F.sum(x).alias(c) for c, x in sums.items()))
    # Equal rows were summed together: share their sums out again.
    each = total.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    part = lambda c: (F.col(c) / F.col("copies"))
    return each.select("doc_id", "held_out", part("n_tokens").cast("bigint").alias("n_tokens"),
                       part("n_known").cast("bigint").alias("n_known"),
                       F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
                       part("base_score").alias("base_score"), part("score").alias("score"))
