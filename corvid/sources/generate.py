"""Data generators (S9-S12), all built on ``spark.range`` so they split across tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_I32 = 1 << 32


def _wrap_int(c: Column) -> Column:
    """Java int arithmetic: keep the low 32 bits, signed."""
    low = F.pmod(c, F.lit(_I32))
    return F.when(low >= F.lit(1 << 31), low - F.lit(_I32)).otherwise(low)


def link_value(i: Column, group: int) -> Column:
    """The generator's per-row value ``-3*i*i + (group + 5) + i`` in Java int arithmetic."""
    i64 = i.cast("bigint")
    sq = _wrap_int(F.lit(-3) * _wrap_int(i64 * i64))
    return _wrap_int(sq + F.lit(group + 5) + i64)


def primes_to(most: int) -> np.ndarray:
    """The primes up to ``most``, ascending."""
    is_prime = np.ones(max(most, 1) + 1, bool)
    is_prime[:2] = False
    for p in range(2, int(max(most, 1) ** 0.5) + 1):
        if is_prime[p]:
            is_prime[p * p:: p] = False
    return np.flatnonzero(is_prime)


def divisors(values: np.ndarray, most: int) -> list[list[int]]:
    """The divisors up to ``most`` of each value (1 .. 2^31), ascending: trial division of all
    values by the primes up to the root of the largest, so the work of a value doesn't grow
    with ``most``."""
    left, found = values.astype("int64"), [[1] for _ in values]

    def times(k: int, p: int, e: int) -> None:
        found[k] = [x for d in found[k] for x in (d * p ** i for i in range(e + 1)) if x <= most]

    for p in primes_to(min(most, int(left.max(initial=0) ** 0.5) + 1)).tolist():
        for k in np.flatnonzero(left % p == 0).tolist():
            e, v = 0, int(left[k])
            while v % p == 0:
                e, v = e + 1, v // p
            left[k] = v
            times(k, p, e)
    for k in np.flatnonzero((left > 1) & (left <= most)).tolist():
        times(k, int(left[k]), 1)  # a prime: it is at most ``most``, and no prime up to its root divides it
    return [sorted(f) for f in found]


def generate_links(spark: SparkSession, n: int, group: int, partitions: int | None = None,
                   chunk: int = 1 << 12) -> DataFrame:
    """Edge i -> j (0 <= i, j < n) iff ``(-3*i*i + group + 5 + i) % (j + 3) == 0``.

    Returns adjacency ``(src bigint, dst array<bigint>)``, targets ascending, one row per node
    (a node without targets has an empty list), like the generated files. A node's targets are
    the divisors of its value from 3 to n + 2, less 3; they come from the value's prime
    factors, so no node tries n candidates. Only a value of 0 links to every node (at most two
    nodes have it, as the rule has at most two roots modulo 2^32). Tasks factor ``chunk`` values at once."""
    def targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, chunk):
                b = whole.slice(at, chunk)
                v = np.abs(b.column("_v").to_numpy())
                lists = divisors(np.where(v == 0, 1, v), n + 2)
                dst = [range(n) if z else [d - 3 for d in f if d >= 3] for z, f in zip((v == 0).tolist(), lists)]
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(dst, pa.list_(pa.int64()))], ["src", "dst"])

    rows = spark.range(0, n, numPartitions=partitions or spark.sparkContext.defaultParallelism)
    return rows.select("id", link_value(F.col("id"), group).alias("_v")).mapInArrow(targets, "src bigint, dst array<bigint>")


def links_text(adj: DataFrame) -> DataFrame:
    """The adjacency in the generator's line format, ``i j j j``."""
    src = F.col("src").cast("string")
    return adj.select(F.when(F.size("dst") == 0, src).otherwise(
        F.concat_ws(" ", src, F.array_join(F.col("dst").cast("array<string>"), " "))).alias("value"))


def generate_points(spark: SparkSession, n: int, dim: int, files: int, seed: int = 0) -> DataFrame:
    """N uniform [0, 10) vectors over ``files`` inputs: n split evenly, the remainder
    going to the first files (the ``file`` column); zero points for a file is an error.
    Seeded, so repeatable."""
    if files <= 0 or n < files:
        raise ValueError("every file needs at least one point")
    q, r = divmod(n, files)
    big = r * (q + 1)                       # points held by the first r files (q + 1 each)
    pid = F.col("id")
    file_of = F.when(pid < big, (pid / F.lit(q + 1)).cast("int")).otherwise(
        (F.lit(r) + ((pid - F.lit(big)) / F.lit(q)).cast("int")))
    rows = spark.range(0, n, numPartitions=files)
    return rows.select(pid.alias("point_id"), file_of.cast("int").alias("file"),
                       F.array(*[F.rand(seed * 1000 + k) * 10.0 for k in range(dim)]).alias("features"))


def generate_centroids(spark: SparkSession, k: int, dim: int, seed: int = 0) -> DataFrame:
    """K uniform [0, 10) centres with ids 0..k-1."""
    rows = spark.range(0, k, numPartitions=1)
    return rows.select(F.col("id").cast("int").alias("cid"),
                       F.array(*[F.rand(seed * 1000 + 500 + d) * 10.0 for d in range(dim)]).alias("center"),
                       F.lit(0).cast("bigint").alias("n"))


def generate_random_edges(spark: SparkSession, n_vertices: int, n_edges: int, seed: int = 0) -> DataFrame:
    """``n_edges`` random links ``(src, val, dst)`` with ``src != dst`` (a clash is
    moved by a non-zero shift, which keeps the target uniform over the other vertices)."""
    if n_vertices < 2:
        raise ValueError("need two vertices for a link without self loops")
    rows = spark.range(0, n_edges)
    src = F.floor(F.rand(seed) * n_vertices).cast("int")
    shift = (F.floor(F.rand(seed + 1) * (n_vertices - 1)) + 1).cast("int")
    return rows.select(src.alias("src"), F.lit(1).alias("val"), shift.alias("_s")).select(
        "src", "val", F.pmod(F.col("src") + F.col("_s"), F.lit(n_vertices)).cast("int").alias("dst"))
