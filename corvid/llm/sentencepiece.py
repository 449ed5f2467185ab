"""Sampled SentencePiece encoding by forward filtering and backward sampling.

The lattice of a text has an edge for every vocabulary piece that its characters spell;
a character that is no piece is one edge of byte pieces. An edge weighs
``alpha * log p``, with ``p`` Zipf-distributed over the merge ranks of the model's pieces.
The forward pass sums the weights of all ways to each position; the backward pass then
draws edges from the end, which samples a segmentation from its exact distribution. All
draws come from a hash of the row's key, the unit and the step, so a row's sample depends
on nothing else: not on its partition, batch or run.

Pieces hold spaces only as a prefix, and never a line feed, so the lattice falls apart
exactly into units (spaces and the word after them; a line feed). Units are filtered once
per worker and kept in a table of bounded size (``TABLE_EDGES``); all units of a slice are
filtered, and all their occurrences sampled, by numpy.

Spaces are written as U+2581 with one space in front of the text, as the model expects; a
U+2581 of the text itself is written in bytes. So decoding returns every text exactly.
Null text: an empty list. Null id: hashed as an empty key. Repeated rows get equal samples.
An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import RangeHash, mix, range_hash, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.5
SEED = 11
TABLE_EDGES = 4_000_000
SLOTS = 1 << 20
UNIT = re.compile(r" +[^ \n]*|[^ \n]+|\n")
SPACE = "▁"


@dataclass(frozen=True)
class Pieces:
    """A model's pieces as plain values, small enough to travel with a task (< 1 MB)."""

    text: tuple[str, ...]
    log_p: tuple[float, ...]     # nan: not a piece that a lattice may use
    byte_ids: tuple[int, ...]    # of the bytes 0..255


def load_pieces(path: str = MODEL) -> Pieces:
    """Reads the vocabulary on the driver."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    text = [m.id_to_piece(i) for i in range(n)]
    special = [m.is_control(i) or m.is_unknown(i) or m.is_unused(i) for i in range(n)]
    byte_ids = {int(text[i][3:5], 16): i for i in range(n) if m.is_byte(i)}
    plain = [i for i in range(n) if not special[i] and not m.is_byte(i)]
    order = sorted(plain, key=lambda i: (-m.get_score(i), i))
    p = 1.0 / (np.arange(len(order)) + 2.0)
    log_p = np.full(n, np.nan)
    log_p[order] = np.log(p / p.sum())
    return Pieces(tuple(text), tuple(log_p.tolist()), tuple(byte_ids[b] for b in range(256)))


class Lattices:
    """Filtered lattices of the units met so far, as flat tables. A state is a position in
    a unit; its edges end there, the likeliest first, and ``cum`` adds up their shares."""

    def __init__(self, pieces: Pieces, alpha: float):
        self.alpha = alpha
        ids = [i for i, p in enumerate(pieces.log_p) if p == p]
        self.log_p, self.byte_ids = np.array(pieces.log_p), np.array(pieces.byte_ids)
        self.byte_log_p = float(np.nanmin(self.log_p))
        prefixes: dict[str, int] = {}
        for i in ids:
            t = pieces.text[i].replace(SPACE, " ")
            for k in range(1, len(t)):
                prefixes.setdefault(t[:k], -1)
            prefixes[t] = i
        text = list(prefixes)
        size = np.array([len(t) for t in text])
        points = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(size)
        h = range_hash(points, ends - size, ends)
        self.hash, self.piece = np.append(h, np.uint64(0)), np.append(np.array(list(prefixes.values())), -2)
        self.slots: list[np.ndarray] = []  # hash tables; what finds its slot taken goes to the next
        left = np.arange(len(h))
        while len(left):
            slot, spot = np.full(SLOTS, len(h), np.int32), self._spot(h[left], len(self.slots))
            slot[spot] = left
            left = left[slot[spot] != left]
            self.slots.append(slot)
        self.clear()

    @staticmethod
    def _spot(h: np.ndarray, nth: int) -> np.ndarray:
        return ((h >> np.uint64(11 * nth)) & np.uint64(SLOTS - 1)).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """For every hash: its piece, -1 if it begins one only, -2 if neither."""
        at = self.slots[0][self._spot(h, 0)]
        for nth in range(1, len(self.slots)):
            miss = np.flatnonzero((self.hash[at] != h) & (self.piece[at] > -2))
            at[miss] = self.slots[nth][self._spot(h[miss], nth)]
        return np.where(self.hash[at] == h, self.piece[at], -2)

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ends: list[int] = []        # of each unit: its first and last state
        self.begins: list[int] = []
        self.states = 0
        self.edges = 0
        self.cum, self.prev, self.id, self.head = (np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.int32))

    @staticmethod
    def _put(old: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
        if used + len(new) > len(old):
            old = np.concatenate([old[:used], np.zeros(max(used, 2 * len(new)), old.dtype)])
        old[used: used + len(new)] = new
        return old

    def add(self, units: list[str]) -> None:
        """Forward filtering of new units, all at once, position by position."""
        size = np.array([len(u) for u in units])
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        unit_end = np.repeat(np.cumsum(size), size)
        unit_begin = unit_end - np.repeat(size, size)
        at, start, end, piece = np.arange(len(points)), [], [], []
        length, hashes = 1, RangeHash(points)
        known = np.zeros(len(points), bool)
        while len(at):
            ids = self._find(hashes(at, at + length))
            at, ids = at[ids >= -1], ids[ids >= -1]
            real = ids >= 0
            if length == 1:
                known[at[real]] = True
            start.append(at[real]), end.append(at[real] + length), piece.append(ids[real])
            length += 1
            at = at[at + length <= unit_end[at]]
        odd = np.flatnonzero(~known)  # characters in bytes; an ASCII one is its byte's piece
        cp = points[odd].astype(np.int64)
        start.append(odd), end.append(odd + 1)
        piece.append(np.where(cp < 128, self.byte_ids[np.minimum(cp, 127)], -cp - 1))
        start, end, piece = (np.concatenate(x).astype(np.int64) for x in (start, end, piece))
        n_bytes = 1 + (-piece > 0x80).astype(np.int64) + (-piece > 0x800) + (-piece > 0x10000)
        weight = self.alpha * np.where(piece >= 0, np.nan_to_num(self.log_p[np.maximum(piece, 0)], nan=self.byte_log_p),
                                       self.byte_log_p * n_bytes)
        # Positions are states: a unit of n characters has n + 1 of them.
        unit = np.repeat(np.arange(len(units)), size)
        s, e = start + unit[start], end + unit[start]
        step = end - unit_begin[start]
        order = np.argsort((step * (len(points) + len(units) + 1) + e) * 64 + (e - s))
        s, e, piece, weight, step = s[order], e[order], piece[order], weight[order], step[order]
        total = np.zeros(len(points) + len(units))
        group = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
        group_step = step[group]
        cut = np.searchsorted(group_step, np.arange(1, int(group_step[-1]) + 2))
        bound = np.append(group, len(e))
        for k in range(len(cut) - 1):
            g0, g1 = cut[k], cut[k + 1]
            if g0 == g1:
                continue
            a, b = bound[g0], bound[g1]
            v = total[s[a:b]] + weight[a:b]
            heads = group[g0:g1] - a
            top = np.maximum.reduceat(v, heads)
            width = np.diff(np.append(heads, b - a))
            total[e[group[g0:g1]]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, width)), heads))
        # Shares in whole 2**-32ths: a unit's table doesn't depend on the units beside it.
        prob = np.rint(np.exp(total[s] + weight - total[e]) * (1 << 32)).astype(np.int64)
        order = np.argsort(e * (1 << 33) + (1 << 32) - prob)
        s, e, piece, prob = s[order], e[order], piece[order], prob[order]
        heads = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
        ends = np.append(heads[1:], len(e)) - 1
        share = np.cumsum(prob)
        share -= np.repeat(share[heads] - prob[heads], ends - heads + 1)
        share[ends] = 1 << 32
        head = np.zeros(len(total), np.int32)
        head[e[heads]] = heads + self.edges
        self.cum = self._put(self.cum, self.edges, share)
        self.prev = self._put(self.prev, self.edges, s + self.states)
        self.id = self._put(self.id, self.edges, piece)
        self.head = self._put(self.head, self.states, head)
        begin = np.cumsum(size + 1) - size - 1 + self.states
        self.begins += begin.tolist()
        self.ends += (begin + size).tolist()
        self.edges += len(e)
        self.states += len(total)

    def sample(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts, one after the other, and the number of each text."""
        if self.edges > TABLE_EDGES:
            self.clear()
        units = [UNIT.findall(" " + t) if t else [] for t in texts]
        index, new = self.index, []
        for us in units:
            for u in set(us).difference(index):
                index[u] = len(index)
                new.append(u)
        if new:
            self.add(new)
        count = np.array([len(us) for us in units])
        of = np.fromiter(map(index.__getitem__, chain.from_iterable(units)), np.int64, int(count.sum()))
        doc = np.repeat(np.arange(len(texts)), count)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        draw = mix(seeds[doc] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        begin, state = np.array(self.begins, np.int64)[of], np.array(self.ends, np.int64)[of]
        live, steps = np.arange(len(of)), []
        drawn = np.zeros(len(of), np.int64)
        while len(live):
            draw[live] = mix(draw[live] + np.uint64(0xD1B54A32D192ED03))
            u = (draw[live] >> np.uint64(32)).astype(np.int64)
            now = state[live]
            edge = self.head[now]
            more = np.flatnonzero(self.cum[edge] <= u)
            while len(more):
                edge[more] += 1
                more = more[self.cum[edge[more]] <= u[more]]
            steps.append((live, self.id[edge]))
            state[live] = self.prev[edge]
            drawn[live] += 1
            live = live[state[live] > begin[live]]
        first = np.cumsum(drawn) - drawn
        out = np.zeros(int(drawn.sum()), np.int64)
        for k, (who, ids) in enumerate(steps):  # drawn from the end
            out[first[who] + drawn[who] - 1 - k] = ids
        n = np.bincount(doc, weights=drawn, minlength=len(texts)).astype(np.int64)
        odd = np.flatnonzero(out < 0)
        if len(odd):
            raw = [chr(-int(c) - 1).encode("utf-8") for c in out[odd]]
            size = np.ones(len(out), np.int64)
            size[odd] = [len(r) for r in raw]
            owner = np.repeat(np.arange(len(texts)), n)
            full = np.repeat(out, size)
            place = np.cumsum(size) - size
            width = size[odd]
            full[np.repeat(place[odd] - (np.cumsum(width) - width), width) + np.arange(width.sum())] = (
                self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)])
            n = np.bincount(owner, weights=size, minlength=len(texts)).astype(np.int64)
            out = full
        return out, n


def piece_bytes(pieces: Pieces) -> list[bytes]:
    """What every id stands for; special ids stand for nothing."""
    out = [t.replace(SPACE, " ").encode("utf-8") if p == p else b"" for t, p in zip(pieces.text, pieces.log_p)]
    for b, i in enumerate(pieces.byte_ids):
        out[i] = bytes([b])
    return out


def decode_ids(ids: list[int], spelled: list[bytes]) -> bytes:
    """The text's UTF-8 bytes, without the space put in front."""
    return b"".join(map(spelled.__getitem__, ids))[1:]


_kept: dict[tuple, Lattices] = {}


def _lattices(pieces: Pieces, alpha: float) -> Lattices:
    """One table per worker and model."""
    k = (hash(pieces), alpha)
    if k not in _kept:
        _kept.clear()
        _kept[k] = Lattices(pieces, alpha)
    return _kept[k]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, alpha: float = ALPHA,
           seed: int = SEED) -> DataFrame:
    """``(doc_id, n_pieces, ids array<int>, lossless)``, one row per input row; ``lossless``:
    the ids decode to exactly the text (checked for every row)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"))
    pieces = load_pieces(model)
    sent = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, spelled = _lattices(sent.value, alpha), piece_bytes(sent.value)
        for s in slices(batches):
            raw = [s.text(i) for i in range(len(s))]
            seeds = np.array([xxhash.xxh64_intdigest(k, seed) for k in s.batch.column("key").to_pylist()], np.uint64)
            ids, n = table.sample([r.decode("utf-8") for r in raw], seeds)
            ends = np.cumsum(n)
            flat = ids.tolist()
            ok = [decode_ids(flat[e - k: e], spelled) == r for e, k, r in zip(ends.tolist(), n.tolist(), raw)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                             pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([s.batch.column("doc_id"), pa.array(n), lists, pa.array(ok)],
                                             ["doc_id", "n_pieces", "ids", "lossless"])

    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, n_pieces bigint, ids array<int>, lossless boolean")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``(doc_id, text)`` from lists of ids (null: empty text)."""
    src = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    sent = encoded.sparkSession.sparkContext.broadcast(load_pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = piece_bytes(sent.value)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                text = [decode_ids(x or [], spelled).decode("utf-8") for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, text string")
