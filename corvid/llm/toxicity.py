"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its lower-cased words (runs of letters, digits and non-ASCII), pairs,
and pairs with one word skipped, hashed to ``2**BITS`` places, each place once. FTRL keeps
a rate per coordinate and its L1 term sets weak weights to exactly zero, so the model is a
short list of (place, weight) that is broadcast.

It is fitted on a bounded sample: of the labelled rows the split allows, the ``MAX_ROWS``
with the smallest id hashes (a documented bound; below it all of them). Their features are
made in parallel and only the sample's features meet in the one task that fits. Labels,
language, source and id are not inputs of a score.

Null text: no features (scored by the bias alone, as is empty text). Null labels or ids are
not learnt from; several labels for one id: its row counts once with the largest. Repeated
rows each get a row. Without training rows every score is a half less a hair, predicted 0.
An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import Slice, is_space, lower, mix, range_hash, slices, smallest_hashes, tokens

BITS = 20
MAX_ROWS = 20_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 10.0, 0.0
POSITIVE = 3.0       # weight of a toxic row's gradient; they are few
SEED = 5
NO_SCORE = 0.4999

_gap = is_space(np.arange(256, dtype=np.uint8))
_gap |= np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def is_held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def places(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every n-gram and skip-gram of a slice, repeats included."""
    data = lower(s.data)
    t = tokens(data, s.offsets, lambda b: _gap[b])
    h = range_hash(data, t.starts, t.ends)
    doc = np.repeat(np.arange(len(s)), t.counts)
    of, out = [doc], [h]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(h) > gap:
            same = np.flatnonzero(doc[gap:] == doc[:-gap])
            of.append(doc[same])
            out.append(mix(h[same] * np.uint64(salt) + h[same + gap]))
    return np.concatenate(of), (np.concatenate(out) >> np.uint64(64 - BITS)).astype(np.int64)


def once(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((doc << BITS) | place)
    return both >> BITS, both & ((1 << BITS) - 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of all places, then the bias (which has no L1 term)."""
    n, z = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    l1 = np.full((1 << BITS) + 1, L1)
    l1[-1] = 0.0
    weight = lambda i: np.where(np.abs(z[i]) <= l1[i], 0.0,
                                -(z[i] - np.sign(z[i]) * l1[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))
    for _ in range(epochs):
        for x, y in zip(rows, labels):
            i = np.append(x, 1 << BITS)
            w = weight(i)
            g = float(sigmoid(w.sum()) - y) * (POSITIVE if y else 1.0)
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - s * w
            n[i] += g * g
    return weight(slice(None))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label: str,
                  learn: Column | None, max_rows: int) -> DataFrame:
    """``(order, label, places)`` of the bounded sample: at most ``max_rows`` rows, whatever
    the number of rows of an id."""
    lab = labels.select(F.col(label_id).alias("doc_id"), F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    lab = lab.filter(~is_held_out(F.col("doc_id")) if learn is None else learn).groupBy("doc_id").agg(
        F.max("label").alias("label"))
    sample = smallest_hashes(lab.withColumn("order", F.xxhash64(F.col("doc_id"), F.lit(SEED))), "order", max_rows, "doc_id")
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    row = F.xxhash64("text").alias("row")
    met = text.join(F.broadcast(sample), "doc_id")  # of max_rows ids at most
    # Rows with one id and text train once; if an id has several texts, rows are cut, too.
    keys = met.select("order", row).distinct()
    met = met.groupBy("order", "label", row).agg(F.first("text").alias("text"))
    if keys.count() > max_rows:
        last = keys.orderBy("order", "row").limit(max_rows).agg(F.max(F.struct("order", "row")).alias("last")).first()["last"]
        met = met.filter(F.struct("order", "row") <= F.struct(F.lit(last["order"]), F.lit(last["row"])))
    met = met.select("order", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            doc, place = once(*places(s))
            first = np.searchsorted(doc, np.arange(len(s) + 1))
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(place.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([s.batch.column("order"), s.batch.column("label"), lists],
                                             ["order", "label", "places"])

    return met.mapInArrow(run, "order bigint, label int, places array<int>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
        label: str = "toxic", learn: Column | None = None, max_rows: int = MAX_ROWS,
        epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray] | None:
    """The model as (places, weights), the bias at place 2**BITS; None without rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[np.ndarray] = []
        order, label_of = [], []
        for b in batches:
            order.append(b.column("order").to_numpy())
            label_of.append(b.column("label").to_numpy())
            lists = b.column("places")
            cut, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            rows += [flat[a:e].copy() for a, e in zip(cut, cut[1:])]
        if not rows:
            return
        key = np.concatenate(order)
        size = np.array([len(r) for r in rows])
        by = np.lexsort((size, key))
        w = fit_ftrl([rows[i] for i in by], np.concatenate(label_of)[by], epochs)
        some = np.append(np.flatnonzero(w[:-1]), 1 << BITS)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(w[some])], ["place", "weight"])

    rows = training_rows(docs, labels, id_col, text_col, label_id, label, learn, max_rows)
    got = rows.repartition(1).mapInArrow(run, "place bigint, weight double").toPandas()
    return (got["place"].to_numpy(np.int64), got["weight"].to_numpy(np.float64)) if len(got) else None


def predict(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per input row: ``(doc_id, held_out, score, predicted)``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      is_held_out(F.col(id_col)).alias("held_out"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros((1 << BITS) + 1)
        if sent.value is not None:
            weight[sent.value[0]] = sent.value[1]
        used = weight[:-1] != 0
        for s in slices(batches):
            doc, place = places(s)
            some = used[place]
            doc, place = once(doc[some], place[some])
            p = sigmoid(np.bincount(doc, weights=weight[place], minlength=len(s)) + weight[-1])
            if sent.value is None:
                p[:] = NO_SCORE
            yield pa.RecordBatch.from_arrays([s.batch.column("doc_id"), s.batch.column("held_out"), pa.array(p),
                                              pa.array((p >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def score(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the labelled sample, then score every document."""
    return predict(docs, fit(docs, labels, **options))
