"""Event queues that are consumed (E4): every worker has a first-in-first-out queue of the
events routed to it; a *poll* takes the next one or finds the queue empty, a *wait* takes the
next one even if it is yet to arrive.

One stream carries both the arrivals and the requests. Because queues are first in, first
out, the n-th request that is served gets the n-th event that arrived, so the keyed state of
a worker is two counters, whatever waits in its queue: events arrived and requests served (or
waiting). The stateful step only numbers rows; a delivery is an equi join of numbered events
and numbered requests on (worker, number), which no hot worker can skew.

Micro-batches follow each other; the rows of one are sorted per worker by (ts, id), arrivals
before requests, by Spark (which spills what it can't hold) and numbered as they pass, an
Arrow batch at a time, so a task's Python holds one batch however many rows a worker has.

Input offsets live in the checkpoint folder, and beside them the counters after each
micro-batch. A micro-batch has a folder of its own in the sink and in the counters; one that
is repeated after a restart writes the same rows again, so each event is delivered once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT, POLL, WAIT = "event", "poll", "wait"
NUMBERED = "worker int, kind string, id bigint, number bigint"
COUNTERS = "worker int, arrived bigint, taken bigint"
_EVENT, _POLL, _WAIT, _HELD = range(4)   # kinds within a step; the last is a worker's counters so far


def arrivals(routed: DataFrame, id_col: str = "event_id", ts_col: str = "ts") -> DataFrame:
    """Routed events (one row per delivery, see :func:`corvid.streaming.route.route`) as rows
    of the queue stream."""
    return routed.select(F.col("recipient").cast("int").alias("worker"), F.col(ts_col).alias("ts"),
                         F.col(id_col).cast("bigint").alias("id"), F.lit(EVENT).alias("kind"))


def requests(df: DataFrame, worker: str, kind: str, id_col: str, ts_col: str = "ts") -> DataFrame:
    """Rows that ask for an event; ``kind`` holds ``poll`` or ``wait``."""
    return df.select(F.col(worker).cast("int").alias("worker"), F.col(ts_col).alias("ts"), F.col(id_col).cast("bigint").alias("id"),
                     F.col(kind).alias("kind"))


def _step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole workers, sorted: a worker's counters, if it has any, then its rows in order.
    What goes from one batch to the next is the last worker and its two counters."""
    worker, arrived, taken = None, 0, 0
    for b in batches:
        workers, kinds, ids, held = (b.column(c).to_numpy(zero_copy_only=False) for c in ("worker", "_k", "_arrived", "_taken"))
        starts = np.flatnonzero(np.diff(workers, prepend=workers[:1] - 1)) if len(workers) else []
        numbers: list[int | None] = []
        for a, z in zip(starts, [*starts[1:], len(workers)]):
            if worker != workers[a]:
                worker, arrived, taken = workers[a], 0, 0
            if kinds[a] == _HELD:
                arrived, taken = int(ids[a]), int(held[a])
            for kind in kinds[a:z].tolist():
                if kind == _EVENT:
                    arrived += 1
                    numbers.append(arrived)
                elif kind == _WAIT or (kind == _POLL and taken < arrived):
                    taken += 1
                    numbers.append(taken)
                else:
                    numbers.append(None)  # a poll of an empty queue, or no row of the queue
        out = pa.RecordBatch.from_arrays([*(b.column(c) for c in ("worker", "kind", "id")), pa.array(numbers, pa.int64())],
                                         ["worker", "kind", "id", "number"])
        yield out.filter(pa.array(kinds != _HELD))


def numbered(rows: DataFrame, counters: DataFrame) -> DataFrame:
    """``(worker, kind, id, number)`` of every row of a micro-batch, given the workers' counters
    before it; ``number`` is null for a poll that found nothing. Rows without a worker belong
    to no queue and are dropped."""
    none = F.lit(0).cast("bigint")
    kind = F.when(F.col("kind") == EVENT, _EVENT).when(F.col("kind") == WAIT, _WAIT).otherwise(_POLL)
    rows = rows.filter(F.col("worker").isNotNull()).select("worker", "ts", "id", "kind", kind.alias("_k"), none.alias("_arrived"), none.alias("_taken"))
    ts = F.lit(None).cast(rows.schema["ts"].dataType).alias("ts")
    before = counters.select("worker", ts, F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("kind"), F.lit(_HELD).alias("_k"),
                             F.col("arrived").alias("_arrived"), F.col("taken").alias("_taken"))
    order = [F.col("worker"), F.col("_k") != _HELD, F.asc_nulls_last("ts"), F.asc_nulls_last("id"), F.col("_k") != _EVENT, F.asc_nulls_last("kind")]
    return rows.unionByName(before).repartition("worker").sortWithinPartitions(*order).mapInArrow(_step, NUMBERED)


def _written(counters: str, sink: str, rows: DataFrame, batch: int) -> None:
    """A micro-batch's numbered rows into the sink, then the counters after it, which follow
    from its own rows and the counters before it."""
    spark = rows.sparkSession
    before = spark.read.schema(COUNTERS).parquet(f"{counters}/{batch - 1}") if batch else spark.createDataFrame([], COUNTERS)
    numbered(rows, before).write.mode("overwrite").parquet(f"{sink}/batch={batch}")
    new = spark.read.schema(NUMBERED).parquet(f"{sink}/batch={batch}")
    highest = lambda is_kind: F.coalesce(F.max(F.when(is_kind, F.col("number"))), F.lit(0))
    ended = new.groupBy("worker").agg(highest(F.col("kind") == EVENT).alias("arrived"),
                                      highest((F.col("kind") != EVENT) | F.col("kind").isNull()).alias("taken"))
    ended.unionByName(before).groupBy("worker").agg(F.max("arrived").alias("arrived"), F.max("taken").alias("taken")).write.mode(
        "overwrite").parquet(f"{counters}/{batch}")


def start_queues(stream: DataFrame, checkpoint: str, sink: str, available_now: bool = True) -> StreamingQuery:
    """Number the stream into a Parquet sink. ``available_now`` drains what is there and
    stops; otherwise micro-batches go on as rows arrive. Limit a micro-batch by the source's
    options (``maxBytesPerTrigger``, ``maxFilesPerTrigger``)."""
    counters = f"{checkpoint.rstrip('/')}-counters"
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda rows, batch: _written(counters, sink, rows, batch)).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")).start()


def deliveries(spark: SparkSession, sink: str) -> DataFrame:
    """``(worker, number, event_id, request_id)`` of every event that arrived so far;
    ``request_id`` is null while it waits in its queue."""
    rows = spark.read.schema(NUMBERED).parquet(sink)
    events = rows.filter(F.col("kind") == EVENT).select("worker", "number", F.col("id").alias("event_id"))
    asked = rows.filter((F.col("kind") != EVENT) & F.col("number").isNotNull()).select("worker", "number", F.col("id").alias("request_id"))
    return events.join(asked, ["worker", "number"], "left")


def empty_polls(spark: SparkSession, sink: str) -> DataFrame:
    """``(worker, request_id)`` of the polls that found an empty queue."""
    rows = spark.read.schema(NUMBERED).parquet(sink)
    return rows.filter((F.col("kind") == POLL) & F.col("number").isNull()).select("worker", F.col("id").alias("request_id"))


def waiting(spark: SparkSession, sink: str) -> DataFrame:
    """``(worker, number, request_id)`` of the waits whose event has not arrived."""
    rows = spark.read.schema(NUMBERED).parquet(sink)
    events = rows.filter(F.col("kind") == EVENT).select("worker", "number")
    return rows.filter(F.col("kind") == WAIT).select("worker", "number", F.col("id").alias("request_id")).join(
        events, ["worker", "number"], "left_anti")
