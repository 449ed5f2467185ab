"""Centroid clustering over dictionaries of subvectors (13).

Vectors of integers are cut into blocks of ``width`` consecutive dimensions. A dictionary
holds the distinct subvectors of each block, and a vector is stored as one code per block.
A round computes the exact squared distance of every dictionary entry to every centroid's
block once; a vector's distance to a centroid is the sum of its codes' partial distances, and
a cluster's component sums are its code counts times the dictionary. Nothing is rounded.

* The dictionary comes from one aggregate over the table: tasks count distinct subvectors
  batch by batch, the counts are merged by block and subvector.
* The width is the widest of ``WIDTHS`` whose dictionary is much smaller than the table
  (``SHARE``), else 1. A dictionary's memory is bounded: its ``ENTRIES`` most frequent
  subvectors have codes, any other is stored beside the codes as it is, and its distance is
  computed from its components, so results don't depend on what fits.
* The encoded table is written once to the shared folder; each round reads it and ships k
  rows of sums per task. Only the bounded dictionary, k centroids and k sums reach the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.session import checkpoint_dir, cut_lineage

DIM, K, ROUNDS, SCALE = 64, 40, 5, 256
WIDTHS = (4, 2, 1)
ENTRIES = 1 << 17        # subvectors with codes: times k distances of 8 bytes, 42 MB for k = 40
SHARE = 8                # a wider block must have this many times fewer subvectors than vectors
LIMIT = 1 << 27          # components beyond this could overflow a 64-bit distance
ROWS = 4096              # vectors worked on at once


@dataclass
class Clusters:
    rows: DataFrame             # id, cluster int, distance bigint, cluster_inertia bigint, inertia bigint
    centroids: np.ndarray       # k x dim, int64
    width: int
    entries: int                # subvectors with codes


def kept_vectors(table: DataFrame, id_col: str, vec_col: str, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``(vec_id, ints array<bigint>)`` of the vectors with exactly ``dim`` components, none
    null, NaN or infinite; a component x becomes floor(scale * x). A component of 2^27 or
    more in size raises: its squared distance may not fit 64 bits."""
    x = F.col(vec_col).cast("array<double>")
    sound = (F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    raw = table.filter(F.coalesce(sound, F.lit(False))).select(F.col(id_col).alias("vec_id"), x.alias("x"))
    scaled = lambda v: v * F.lit(float(scale))
    fail = F.raise_error(F.lit(f"clustering: a component of {LIMIT} or more after scaling")).cast("bigint")
    return raw.select("vec_id", F.transform("x", lambda v: F.when(
        F.abs(scaled(v)) < LIMIT, F.floor(scaled(v)).cast("bigint")).otherwise(fail)).alias("ints"))


def starting_centroids(vectors: DataFrame, k: int = K) -> np.ndarray:
    """The k vectors with the smallest hex sha256 of ``2:<vec_id>`` (a null id: ``2:``), in
    that order; equal ids by components."""
    key = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "ints").orderBy("key", "ints").limit(k).collect()
    return np.array([r["ints"] for r in rows], np.int64).reshape(len(rows), len(rows[0]["ints"]) if rows else 0)


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.cast(pa.list_(pa.int64()))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, len(b), ROWS):
            yield b.slice(i, ROWS)


def subvectors(vectors: DataFrame, dim: int, width: int) -> DataFrame:
    """``(block int, sub array<bigint>, n bigint)``: the distinct subvectors of each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            x = _matrix(b.column(0))
            for k in range(0, dim, width):
                sub, n = np.unique(x[:, k: k + width], axis=0, return_counts=True)
                lists = pa.ListArray.from_arrays(np.arange(0, sub.size + 1, sub.shape[1], dtype=np.int32), sub.ravel())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sub), k // width, np.int32)), lists, pa.array(n)],
                                                 ["block", "sub", "n"])

    parts = vectors.select("ints").mapInArrow(run, "block int, sub array<bigint>, n bigint")
    return parts.groupBy("block", "sub").agg(F.sum("n").alias("n"))


def dictionary(vectors: DataFrame, dim: int, entries: int = ENTRIES, width: int | None = None,
               shared: str | None = None) -> tuple[int, list[np.ndarray]]:
    """The block width and each block's subvectors, in ascending order (at most ``entries``
    in all, the most frequent ones)."""
    shared = shared or f"{checkpoint_dir(vectors.sparkSession).rstrip('/')}/subvectors-{uuid.uuid4().hex}"
    n_rows = vectors.count()
    for w in (width,) if width else WIDTHS:
        subvectors(vectors, dim, w).write.parquet(f"{shared}/{w}")
        found = vectors.sparkSession.read.parquet(f"{shared}/{w}")
        n = found.count()
        if w == 1 or width or (n <= entries and n * SHARE <= n_rows * -(-dim // w)):
            break
    top = found if n <= entries else found.orderBy(F.desc("n"), "block", "sub").limit(entries)
    blocks: list[list] = [[] for _ in range(0, dim, w)]
    for r in top.collect():
        blocks[r["block"]].append(r["sub"])
    return w, [np.array(sorted(b), np.int64).reshape(len(b), min(w, dim - k * w)) for k, b in enumerate(blocks)]


def encode(vectors: DataFrame, width: int, blocks: list[np.ndarray]) -> DataFrame:
    """``(vec_id, codes array<int>, rest array<bigint>)``: one code per block, -1 where the
    block's subvector has none; ``rest`` holds the components of those blocks in order."""
    sent = vectors.sparkSession.sparkContext.broadcast(blocks)
    schema = T.StructType([vectors.schema["vec_id"], T.StructField("codes", T.ArrayType(T.IntegerType())),
                           T.StructField("rest", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = []
        for values in sent.value:
            keys = [v.tobytes() for v in values]
            books.append(dict(zip(keys, range(len(keys)))))
        single = width == 1 and all(len(v) for v in sent.value)
        for b in _chunks(batches):
            x = _matrix(b.column("ints"))
            codes = np.full((len(x), len(books)), -1, np.int32)
            for k, (book, values) in enumerate(zip(books, sent.value)):
                part = np.ascontiguousarray(x[:, k * width: (k + 1) * width])
                if single:
                    at = np.searchsorted(values[:, 0], part[:, 0]).clip(max=len(values) - 1)
                    codes[:, k] = np.where(values[at, 0] == part[:, 0], at, -1)
                else:
                    distinct, back = np.unique(part, axis=0, return_inverse=True)
                    codes[:, k] = np.array([book.get(v.tobytes(), -1) for v in distinct], np.int32)[back.ravel()]
            missing = np.repeat(codes == -1, [values.shape[1] for values in sent.value], axis=1)
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(missing.sum(1))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"),
                 pa.ListArray.from_arrays(np.arange(0, codes.size + 1, len(books), dtype=np.int32), codes.ravel()),
                 pa.ListArray.from_arrays(ends, x[missing])], ["vec_id", "codes", "rest"])

    return vectors.select("vec_id", "ints").mapInArrow(run, schema)


class _Round:
    """What a task needs for one round: the partial distances of every code, once."""

    def __init__(self, blocks: list[np.ndarray], tables: list[np.ndarray], centroids: np.ndarray):
        self.blocks, self.tables, self.centroids = blocks, tables, centroids
        self.widths = [v.shape[1] for v in blocks]
        self.first = np.concatenate([[0], np.cumsum(self.widths)])

    def literals(self, b: pa.RecordBatch, codes: np.ndarray) -> np.ndarray | None:
        """The vectors' components, where they are stored beside the codes."""
        missing = codes == -1
        if not missing.any():
            return None
        out = np.zeros((len(codes), self.first[-1]), np.int64)
        out[np.repeat(missing, self.widths, axis=1)] = b.column("rest").flatten().to_numpy(zero_copy_only=False)
        return out

    def assign(self, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        codes = b.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(len(b), len(self.blocks))
        rest = self.literals(b, codes)
        total = np.zeros((len(b), len(self.centroids)), np.int64)
        for k, table in enumerate(self.tables):
            if rest is None:
                total += table[codes[:, k]]
                continue
            has = codes[:, k] >= 0
            total[has] += table[codes[has, k]]
            own = rest[~has, self.first[k]: self.first[k + 1]]
            for j in range(own.shape[1]):  # no code: from the components
                total[~has] += (own[:, j, None] - self.centroids[None, :, self.first[k] + j]) ** 2
        best = total.argmin(1)  # the first of equal distances
        return codes, best, total[np.arange(len(b)), best], rest


def distance_tables(blocks: list[np.ndarray], centroids: np.ndarray) -> list[np.ndarray]:
    """Squared distance of every subvector to every centroid's block."""
    out, first = [], 0
    for values in blocks:
        part = centroids[:, first: first + values.shape[1]]
        table = np.zeros((len(values), len(centroids)), np.int64)
        for j in range(values.shape[1]):
            table += (values[:, j, None] - part[None, :, j]) ** 2
        out.append(table)
        first += values.shape[1]
    return out


def cluster_sums(encoded: DataFrame, sent) -> DataFrame:
    """``(cluster, pos, total)`` summed over the table; ``pos`` -1 is the cluster's size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Round = sent.value
        k = len(now.centroids)
        size, extra = np.zeros(k, np.int64), np.zeros((k, now.first[-1]), np.int64)
        counts = [np.zeros((len(v), k), np.int64) for v in now.blocks]
        for b in _chunks(batches):
            codes, best, _, rest = now.assign(b)
            size += np.bincount(best, minlength=k)
            for j, c in enumerate(counts):
                has = codes[:, j] >= 0
                c += np.bincount(codes[has, j].astype(np.int64) * k + best[has], minlength=c.size).reshape(c.shape)
            if rest is not None:
                np.add.at(extra, best, rest)
        if not size.any():
            return
        for j, (c, values) in enumerate(zip(counts, now.blocks)):
            extra[:, now.first[j]: now.first[j + 1]] += c.T @ values
        some = np.flatnonzero(size)
        got = np.column_stack([size[some], extra[some]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, got.shape[1]).astype(np.int32)),
             pa.array(np.tile(np.arange(-1, got.shape[1] - 1, dtype=np.int32), len(some))), pa.array(got.ravel())],
            ["cluster", "pos", "total"])

    parts = encoded.mapInArrow(run, "cluster int, pos int, total bigint")
    return parts.groupBy("cluster", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def cluster(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM, k: int = K,
            rounds: int = ROUNDS, scale: int = SCALE, width: int | None = None, entries: int = ENTRIES) -> Clusters:
    """``rounds`` rounds from the starting centroids, then a last assignment.

    Vectors of another length, or with a null, NaN or infinite component, are left out. A
    tie goes to the smaller number. A non-empty cluster's centroid becomes the floor of its
    exact mean; an empty one's stays. Rows that repeat count as often as they occur; with
    fewer than k vectors each is a centroid; an empty table gives no rows. Other columns are
    not read.
    """
    spark = table.sparkSession
    shared = f"{checkpoint_dir(spark).rstrip('/')}/codebook-{uuid.uuid4().hex}"
    kept_vectors(table, id_col, vec_col, dim, scale).write.parquet(f"{shared}/vectors")
    vectors = spark.read.parquet(f"{shared}/vectors")
    centroids = starting_centroids(vectors, k)
    schema = T.StructType([vectors.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not len(centroids):
        empty = spark.createDataFrame([], schema).withColumns({c: F.lit(None).cast("bigint") for c in ("cluster_inertia", "inertia")})
        return Clusters(empty, centroids, 0, 0)
    w, blocks = dictionary(vectors, dim, entries, width, f"{shared}/subvectors")
    encode(vectors, w, blocks).write.parquet(f"{shared}/codes")
    encoded = spark.read.parquet(f"{shared}/codes")

    def round_of(c: np.ndarray):
        return spark.sparkContext.broadcast(_Round(blocks, distance_tables(blocks, c), c))

    for _ in range(rounds):
        sent = round_of(centroids)
        sums = {(r["cluster"], r["pos"]): int(r["total"]) for r in cluster_sums(encoded, sent).collect()}  # k * (dim + 1)
        centroids = centroids.copy()
        for c in {c for c, _ in sums}:
            centroids[c] = [sums[c, j] // sums[c, -1] for j in range(dim)]
        sent.unpersist()
    sent = round_of(centroids)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            _, best, dist, _ = sent.value.assign(b)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(dist)],
                                             ["vec_id", "cluster", "distance"])

    rows = cut_lineage(encoded.mapInArrow(last, schema))
    inertia = cut_lineage(rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")))  # at most k rows
    total = inertia.agg(F.sum("cluster_inertia").alias("inertia")).first()["inertia"]
    out = rows.join(F.broadcast(inertia), "cluster").withColumn("inertia", F.lit(total).cast("bigint"))
    return Clusters(out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia"), centroids, w,
                    sum(map(len, blocks)))


def centroid_table(spark, got: Clusters) -> DataFrame:
    """``(cluster int, center array<bigint>, centroid_sha256 string)``: the hash of the
    components as decimals joined by commas."""
    rows = [(i, [int(v) for v in c], hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest())
            for i, c in enumerate(got.centroids)]
    return spark.createDataFrame(rows, "cluster int, center array<bigint>, centroid_sha256 string")
