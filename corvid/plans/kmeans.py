"""K-means from caller-supplied centroids.

Each round is one Spark job over the points. The current centres (k x d values, the size
the reference broadcasts every round) are broadcast; each task compares Arrow batches of
points with them and keeps k running sums, so it ships at most k rows whatever the skew
between clusters, and nothing depends on k x d being small enough to write out as
expressions. Only the k new centres return to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.session import persist

BLOCK = 1 << 22  # distances times dimensions computed at once


@dataclass
class KMeansResult:
    centroids: DataFrame    # cid int, center array<double>, n bigint
    errors: list[float]     # per round: sum of point-to-nearest-centre distances


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """A batch's vectors as rows; a vector of another width fails, as in the reference."""
    lists = column.cast(pa.list_(pa.float64()))
    widths = np.diff(lists.offsets.to_numpy())
    if lists.null_count or (widths != dim).any():
        raise ValueError(f"k-means: a point without {dim} coordinates")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (the first of equals; -1 if every distance is NaN, the
    reference's initial value) and the distance."""
    at, dist = np.full(len(x), -1), np.full(len(x), np.nan)
    if not len(centres):
        return at, dist
    step = max(1, BLOCK // max(centres.size, 1))
    for i in range(0, len(x), step):
        d = np.sqrt(((x[i: i + step, None, :] - centres[None, :, :]) ** 2).sum(2))
        best = np.where(np.isnan(d), np.inf, d).argmin(1)
        dist[i: i + step] = d[np.arange(len(d)), best]
        at[i: i + step] = np.where(np.isnan(d).all(1), -1, best)
    return at, dist


def _arrays(centres: list[tuple[int, list[float]]]) -> tuple[np.ndarray, np.ndarray]:
    centres = sorted(centres)  # equal distances go to the lowest cid
    return (np.array([c for c, _ in centres], np.int32),
            np.array([v for _, v in centres], np.float64).reshape(len(centres), -1))


class Groups:
    """Centres in about sqrt(k) groups around pivots, for an exact search that skips groups:
    a group whose pivot is at distance d and whose farthest member is r from the pivot has no
    centre nearer than d - r (triangle inequality)."""

    def __init__(self, centres: np.ndarray, rounds: int = 3):
        k = len(centres)
        self.centres = centres
        self.pivots = centres[np.linspace(0, k - 1, max(1, round(k ** 0.5))).astype(int)].copy()
        for _ in range(rounds):
            own, _ = _nearest(centres, self.pivots)
            for g in np.unique(own):
                self.pivots[g] = centres[own == g].mean(0)
        own, dist = _nearest(centres, self.pivots)
        self.members = [np.flatnonzero(own == g) for g in range(len(self.pivots))]  # ascending: the first of equals is kept
        self.radius = np.array([dist[m].max(initial=0.0) for m in self.members])
        self.used = np.array([len(m) > 0 for m in self.members])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """As :func:`_nearest`, and the number of distances computed."""
        to = np.sqrt(((x[:, None, :] - self.pivots[None, :, :]) ** 2).sum(2))
        count = to.size
        # Rounding can't hide a centre: the bound is lowered by far more than it can be off.
        bound = np.where(self.used, to - self.radius - 1e-9 * (to + self.radius), np.inf)
        order = np.argsort(bound, axis=1)
        at, dist = np.full(len(x), len(self.centres)), np.full(len(x), np.inf)
        todo = np.arange(len(x))
        for place in range(len(self.pivots)):
            g = order[todo, place]
            todo = todo[bound[todo, g] <= dist[todo]]
            if not len(todo):
                break
            g = order[todo, place]
            for group in np.unique(g):
                rows, m = todo[g == group], self.members[group]
                d = np.sqrt(((x[rows, None, :] - self.centres[m][None, :, :]) ** 2).sum(2))
                count += d.size
                best = d.argmin(1)
                near, who = d[np.arange(len(rows)), best], m[best]
                better = (near < dist[rows]) | ((near == dist[rows]) & (who < at[rows]))
                at[rows[better]], dist[rows[better]] = who[better], near[better]
        return at, dist, count


PRUNE_FROM = 64   # centres from which the grouped search pays
GROUP_ROWS = 4096


def _nearest_of_many(x: np.ndarray, groups: Groups) -> tuple[np.ndarray, np.ndarray, int]:
    """:func:`_nearest` by groups; vectors that aren't finite are compared with all centres."""
    at, dist, count = np.full(len(x), -1), np.full(len(x), np.nan), 0
    finite = np.isfinite(x).all(1)
    rows = np.flatnonzero(finite)
    for i in range(0, len(rows), GROUP_ROWS):
        r = rows[i: i + GROUP_ROWS]
        at[r], dist[r], n = groups.nearest(x[r])
        count += n
    odd = np.flatnonzero(~finite)
    at[odd], dist[odd] = _nearest(x[odd], groups.centres)
    return at, dist, count + len(odd) * len(groups.centres)


def _search(centres: np.ndarray, prune: bool | None):
    """The search that a task uses: by groups from ``PRUNE_FROM`` centres on (or as asked)."""
    if (len(centres) >= PRUNE_FROM if prune is None else prune) and len(centres) and np.isfinite(centres).all():
        groups = Groups(centres)
        return lambda x: _nearest_of_many(x, groups)[:2]
    return lambda x: _nearest(x, centres)


def assign_nearest(points: DataFrame, centres: list[tuple[int, list[float]]], features: str = "features",
                   prune: bool | None = None) -> DataFrame:
    """Nearest centre per point -> ``(..., cid int, dist double)``. Strict ``<`` in the
    reference keeps the first of equal distances; here equal distances go to the lowest
    cid. With no centre at all, cid is -1 and the distance null. ``prune``: skip groups of
    centres by the triangle inequality (by default from ``PRUNE_FROM`` centres on); the
    result is the same."""
    if not centres:
        return points.select("*", F.lit(-1).alias("cid"), F.lit(None).cast("double").alias("dist"))
    sent = points.sparkSession.sparkContext.broadcast(_arrays(centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cids, c = sent.value
        search = _search(c, prune)
        for b in batches:
            at, dist = search(_vectors(b.column(features), c.shape[1]))
            cid = np.where(at < 0, -1, cids[at]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cid), pa.array(dist)], [*b.schema.names, "cid", "dist"])

    schema = T.StructType([*points.schema.fields, T.StructField("cid", T.IntegerType()), T.StructField("dist", T.DoubleType())])
    return points.mapInArrow(run, schema)


def _dim_sums(features: str, dim: int) -> Column:
    """``array(sum(features[0]), ..., sum(features[dim-1]))`` as one SQL expression: a
    single call to build however wide the vectors are."""
    return F.expr("array(" + ", ".join(f"sum(`{features}`[{i}])" for i in range(dim)) + ")")


def new_centres(assigned: DataFrame, dim: int, features: str = "features") -> DataFrame:
    """Mean per cluster, one sum per dimension; clusters that received no point
    disappear (only assigned ids enter the new table)."""
    g = assigned.groupBy("cid").agg(F.count(F.lit(1)).alias("n"), _dim_sums(features, dim).alias("_s"))
    return g.select("cid", F.transform("_s", lambda x: x / F.col("n")).alias("center"), "n")


def clustering_error(assigned: DataFrame) -> DataFrame:
    """Sum of (not squared) distances to the nearest centre."""
    return assigned.agg(F.sum("dist").alias("error"))


def partial_sums(points: DataFrame, centres: list[tuple[int, list[float]]], features: str = "features") -> DataFrame:
    """``(cid, n, err, sums)`` per task: the round's combine on the map side."""
    sent = points.sparkSession.sparkContext.broadcast(_arrays(centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cids, c = sent.value
        search = _search(c, None)
        n, err, sums = np.zeros(len(c), np.int64), np.zeros(len(c)), np.zeros(c.shape)
        for b in batches:
            x = _vectors(b.column(0), c.shape[1])
            at, dist = search(x)
            ok = at >= 0
            n += np.bincount(at[ok], minlength=len(c))
            err += np.bincount(at[ok], weights=dist[ok], minlength=len(c))
            np.add.at(sums, at[ok], x[ok])
        some = np.flatnonzero(n)
        lists = pa.array([sums[i].tolist() for i in some], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(cids[some]), pa.array(n[some]), pa.array(err[some]), lists],
                                         ["cid", "n", "err", "sums"])

    return points.select(features).mapInArrow(run, "cid int, n bigint, err double, sums array<double>")


def kmeans(points: DataFrame, centroids: DataFrame, iterations: int, features: str = "features",
           cache: bool = False) -> KMeansResult:
    """Exactly ``iterations`` rounds from the given start, no early stop. ``cache``
    keeps the points between rounds; otherwise each round scans them."""
    spark = points.sparkSession
    pts = persist(points.select(features)) if cache else points.select(features)
    centres = [(int(r["cid"]), [float(x) for x in r["center"]]) for r in centroids.select("cid", "center").toLocalIterator()]
    if len({len(v) for _, v in centres}) > 1:
        raise ValueError("k-means: centres of different widths")
    errors: list[float] = []
    sizes: dict[int, int] = {}
    for _ in range(iterations if centres else 0):
        dim = len(centres[0][1])
        got = partial_sums(pts, centres, features).groupBy("cid").agg(
            F.sum("n").alias("n"), F.sum("err").alias("err"), _dim_sums("sums", dim).alias("s")).collect()
        if not got:
            break
        errors.append(float(sum(r["err"] for r in got)))
        centres = sorted((int(r["cid"]), [x / r["n"] for x in r["s"]]) for r in got)
        sizes = {int(r["cid"]): int(r["n"]) for r in got}
    if cache:
        pts.unpersist()
    # n: points in each cluster in the last round (the reference zeroes this slot).
    out = spark.createDataFrame([(c, v, sizes.get(c, 0)) for c, v in centres],
                                "cid int, center array<double>, n bigint")
    return KMeansResult(out, errors)
