"""Task functions over co-located keyed tables (the map-collective and task hooks, SURVEY 2.9).

A task sees matching pieces of two keyed tables: all rows of both whose keys fall into the
same bucket. The tables are combined by key first, so a piece holds one row per key and
table, and there are as many buckets as keep a piece at ``rows_per_task`` rows on average:
no task's memory grows with the data or with a hot key.
"""

from __future__ import annotations

import atexit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.combiners import Combiner
from corvid.operators import keyed

ROWS_PER_TASK = 50_000


class Task:
    """What runs on the workers. ``setup`` is called once in each Python worker before its
    first piece (load a model, open a connection), ``cleanup`` when that worker ends."""

    def setup(self) -> None:
        pass

    def run(self, left: pa.Table, right: pa.Table) -> pa.Table:
        raise NotImplementedError

    def cleanup(self) -> None:
        pass


_ready: dict[bytes, Task] = {}


def _prepared(packed: bytes) -> Task:
    if packed not in _ready:
        from pyspark import cloudpickle

        task: Task = cloudpickle.loads(packed)
        task.setup()
        atexit.register(task.cleanup)
        _ready[packed] = task
    return _ready[packed]


def run_tasks(left: DataFrame, right: DataFrame, key: str, task: Task, schema: str, left_combiner: Combiner | None = None,
              right_combiner: Combiner | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``task.run`` on every pair of pieces, its tables concatenated (columns as ``schema``).
    A key that only one table has is in that side's piece alone. Without a combiner the keys
    of that table must be unique."""
    from pyspark import cloudpickle

    packed = cloudpickle.dumps(task)
    sides = [keyed.combine_by_id(df, key, c) for df, c in ((left, left_combiner), (right, right_combiner))]
    n = max(1, -(-sum(df.count() for df in sides) // rows_per_task))
    bucket = F.pmod(F.xxhash64(key), F.lit(n)).alias("_task")
    a, b = (df.select("*", bucket).groupBy("_task") for df in sides)
    return a.cogroup(b).applyInArrow(lambda x, y: _prepared(packed).run(x.drop(["_task"]), y.drop(["_task"])), schema)
