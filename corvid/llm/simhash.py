"""SimHash near-dedup with pivot distance tables.

1. Each text's 64-bit fingerprint: A-Z lower-cased, 4-word shingles (repeats included,
   joined by one space), XXH64 (seed 42) of each; a bit is 1 if it is set in over half of
   the hashes. A text without words has fingerprint 0 and is linked like any other.
2. Equal fingerprints are one node (so thousands of exact copies are one row from here).
3. Two fingerprints that differ in at most ``d`` of 64 bits agree on ``blocks - d`` of
   ``blocks`` bit blocks, so each node goes once to every choice of that many blocks, and
   only nodes that agree on a choice meet. The number of blocks follows the node count, so
   a choice's value is shared by a few unrelated nodes only.
4. Where nodes meet, a table of Hamming distances to ``PIVOTS`` reference fingerprints is
   computed; a pair whose coordinates differ by more than ``d`` anywhere is discarded (by
   the triangle inequality it cannot be within ``d``), the survivors are verified bit by
   bit. A large meeting (near copies) is searched breadth first: a node that was reached
   is not compared again, so it costs members x unreached, and yields a spanning forest
   rather than all pairs; no link between different fingerprints is lost for reachability.
   Meetings are counted first. One of more than ``CROWD`` nodes never comes to one task: its
   nodes go to choices of blocks of the bits that the meeting leaves open, as many bits as
   its size asks for, and meet there, again and again while a meeting is a crowd. Its nodes
   agree on all other bits, so once 12 bits are open it is none.
5. Components by star rounds (:mod:`corvid.llm.components`); the label is the smallest id.

Null id: its row is fingerprinted and labelled, but it can't be a label itself. Repeated
rows each get a row. An empty table gives an empty result. Only the id and text columns
are read, so extra columns never clash.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import fresh, mix, slices, words_of
from corvid.llm.components import connected
from corvid.session import cut_lineage

SEED = 42
SHINGLE = 4
MAX_BITS = 4
PIVOTS = 24          # reference fingerprints
SMALL = 32           # meetings up to this size compare neighbours by lag
CROWD = 4096         # meetings above this size are split by further bits


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text (unsigned)."""
    words = words_of(text.lower())  # bytes.lower changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], space + 1])
    ends = np.concatenate([space, [len(joined)]])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        s, e = starts[i: min(n, i + (1 << 16))].tolist(), ends[i + k - 1: min(n, i + (1 << 16)) + k - 1].tolist()
        h = np.array([digest(joined[a:b], seed) for a, b in zip(s, e)], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """``(doc_id, row_hash, fp)``, one row per input row: a hash of the text, and the
    fingerprint as a signed long."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            fp = np.array([simhash(s.text(i), shingle, seed) for i in range(len(s))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([s.batch.column("doc_id"), s.batch.column("row_hash"), pa.array(fp)],
                                             ["doc_id", "row_hash", "fp"])

    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, row_hash bigint, fp bigint")


def block_choices(nodes: int, max_bits: int = MAX_BITS, known: int = 0) -> list[int]:
    """Bit masks, one for each choice of blocks of the bits that ``known`` leaves open. The
    fewest blocks for which a choice's value is shared by about four unrelated nodes at most."""
    bits = [i for i in range(64) if not known >> i & 1]
    for blocks in range(max_bits + 1, 17):
        kept = blocks - max_bits
        if len(bits) * kept // blocks >= math.log2(max(nodes, 1)) - 2:
            break
    cuts = [len(bits) * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:])]
    return [known | sum(c) for c in itertools.combinations(masks, kept)]


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints (fixed pseudo-random constants)."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def distance_table(fp: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint to every reference, (refs, fingerprints)."""
    return np.bitwise_count(fp[None, :] ^ refs[:, None]).astype(np.int8)


def _survivors(a: np.ndarray, b: np.ndarray, table: np.ndarray, max_bits: int) -> np.ndarray:
    """Which index pairs (a, b) no pivot rules out; each pivot sees only what is left."""
    left = np.arange(len(a))
    for row in table:
        if not len(left):
            break
        left = left[np.abs(row[a[left]] - row[b[left]]) <= max_bits]
    return left


def _small_groups(fp: np.ndarray, group: np.ndarray, size: int, refs: np.ndarray, max_bits: int):
    """Pairs within runs of equal ``group`` of at most ``size`` members, by lag."""
    table = distance_table(fp, refs)
    for lag in range(1, size):
        a = np.flatnonzero(group[:-lag] == group[lag:]) if len(group) > lag else np.zeros(0, np.int64)
        if not len(a):
            break
        left = _survivors(a, a + lag, table, max_bits)
        a = a[left]
        a = a[np.bitwise_count(fp[a] ^ fp[a + lag]) <= max_bits]
        yield fp[a], fp[a + lag]


def _large_group(fp: np.ndarray, refs: np.ndarray, max_bits: int):
    """A spanning forest of one large meeting. The unreached members are kept in order of
    their distance to the first pivot, so a search looks only at the members within
    ``max_bits`` of it there, then at the other pivots, then at the bits."""
    table = distance_table(fp, refs)
    order = np.argsort(table[0], kind="stable")
    fp, table = fp[order], table[:, order]
    alive = np.arange(len(fp))
    first = table[0]
    while len(alive):
        queue, alive = [int(alive[0])], alive[1:]
        while queue and len(alive):
            x = queue.pop()
            lo, hi = np.searchsorted(first[alive], [first[x] - max_bits, first[x] + max_bits + 1])
            near = alive[lo:hi]
            near = near[_survivors(np.full(len(near), x), near, table[1:], max_bits)]
            near = near[np.bitwise_count(fp[near] ^ fp[x]) <= max_bits]
            if len(near):
                yield np.full(len(near), fp[x]), fp[near]
                alive = alive[~np.isin(alive, near, assume_unique=True)]
                queue.extend(near.tolist())


def _masked(mask: int) -> Column:
    return F.col("fp").bitwiseAND(F.lit(mask - (mask >> 63 << 64)).cast("bigint"))


def meetings(nodes: DataFrame, max_bits: int = MAX_BITS, count: int | None = None, crowd: int = CROWD) -> DataFrame:
    """``(fp, choice, value)``: the nodes where they meet, in meetings of at most ``crowd``
    nodes (or with few open bits). Only the choices that hold crowds, with their largest
    meeting, reach the driver."""
    masks = dict(enumerate(block_choices(nodes.count() if count is None else count, max_bits)))
    met = nodes.select("fp", F.posexplode(F.array(*[_masked(m) for m in masks.values()])).alias("choice", "value"))
    done: list[DataFrame] = []
    while True:
        crowds = cut_lineage(met.groupBy("choice", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd))
        most = {r["choice"]: r["n"] for r in crowds.groupBy("choice").agg(F.max("n").alias("n")).collect()}
        split = {c: [m for m in block_choices(most[c], max_bits, masks[c]) if m != masks[c]] for c in sorted(most)}
        # A choice with too few open bits to cut them into blocks is searched as it is.
        split = {c: further for c, further in split.items() if 64 - masks[c].bit_count() >= 3 * max_bits and further}
        if not split:
            return functools.reduce(DataFrame.unionByName, done, met)
        keys = crowds.filter(F.col("choice").isin(list(split))).select("choice", "value")
        done.append(met.join(keys, ["choice", "value"], "left_anti").select("fp", "choice", "value"))
        many = cut_lineage(met.join(keys, ["choice", "value"], "left_semi").select("fp", "choice"))
        first = max(masks) + 1
        places = [(c, m) for c, further in split.items() for m in further]
        masks = {first + i: m for i, (_, m) in enumerate(places)}
        at = nodes.sparkSession.createDataFrame(
            [(c, first + i, m - (m >> 63 << 64)) for i, (c, m) in enumerate(places)], "choice int, next int, mask bigint")
        met = many.join(F.broadcast(at), "choice").select(
            "fp", F.col("next").alias("choice"), F.col("fp").bitwiseAND(F.col("mask")).alias("value"))


def links(nodes: DataFrame, max_bits: int = MAX_BITS, count: int | None = None, crowd: int = CROWD) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (column ``fp``) at ``max_bits`` or
    fewer differing bits, at least a spanning forest of them for each block value."""
    placed = meetings(nodes, max_bits, count, crowd).repartition("choice", "value").sortWithinPartitions("choice", "value")

    def edges(fp: np.ndarray, group: np.ndarray, refs: np.ndarray):
        cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.concatenate([cut, [len(group)]]))
        small = np.repeat((size > 1) & (size <= SMALL), size)
        if small.any():
            yield from _small_groups(fp[small], group[small], SMALL, refs, max_bits)
        for i in np.flatnonzero(size > SMALL):
            yield from _large_group(fp[cut[i]: cut[i] + size[i]], refs, max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        rest: list[list[np.ndarray]] = []  # a meeting that may go on in the next batch
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                rest.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "choice", "value")])
                if (rest[0][1][0], rest[0][2][0]) == (rest[-1][1][-1], rest[-1][2][-1]):
                    continue
            if not rest:
                continue
            fp, choice, value = (np.concatenate([r[k] for r in rest]) for k in range(3))
            new = np.concatenate([[True], (choice[1:] != choice[:-1]) | (value[1:] != value[:-1])])
            group = np.cumsum(new)
            end = len(fp) if batch is None else int(np.flatnonzero(new)[-1])
            rest = [] if batch is None else [[fp[end:], choice[end:], value[end:]]]
            if end:
                for a, b in edges(fp[:end].view(np.uint64), group[:end], refs):
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                         ["a", "b"])

    return placed.mapInArrow(run, "a bigint, b bigint")


def _rooted(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, low, root)``: every distinct fingerprint, its smallest id, its component.
    Written out, so that a join with a fingerprint's many documents can be split."""
    nodes = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    label = connected(links(nodes.select("fp"), max_bits, nodes.count()))
    return cut_lineage(nodes.join(label, F.col("fp") == F.col("a"), "left").select(
        "fp", "low", F.coalesce("b", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per input row."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle, seed))
    named = _rooted(fps, max_bits)
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of = cut_lineage(named.join(lowest, "root").select("fp", "component_id"))
    return fps.join(of, "fp").select("doc_id", "fp", "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
              max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the smallest
    id (null last; of equal ids, the smallest text hash; of rows that differ in other columns
    only, the smallest hash of the row)."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle, seed))
    root = _rooted(fps, max_bits).select("fp", "root")
    first = fps.join(root, "fp").groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("late"), "doc_id", "row_hash")).alias("s"))
    sid, srow, row = (fresh(docs, c) for c in ("_s_id", "_s_row", "_row"))
    keep = first.select(F.col("s.doc_id").alias(sid), F.col("s.row_hash").alias(srow))
    marked = docs.withColumn(row, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    met = marked.join(keep, F.col(id_col).eqNullSafe(F.col(sid)) & (F.col(row) == F.col(srow)), "left_semi")
    whole = F.xxhash64(*[F.col(f"`{f.name}`").cast("string") if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`")
                         for f in docs.schema.fields])
    one = met.groupBy(F.col(id_col).alias(sid), F.col(row).alias(srow)).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), whole).alias(row))
    return one.select(f"{row}.*")
