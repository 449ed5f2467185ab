"""Combiners: what happens when two rows with the same id meet (G1-G12, §2.9).

A combiner is a set of aggregate expressions over payload columns. Applying one is a
``groupBy(key).agg(...)``; Spark plans it as a partial aggregate before the shuffle and
a final one after it, which is the reference's "combine locally, send, combine on
arrival" — and what keeps a hot key from landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


@dataclass(frozen=True)
class Combiner:
    """Named aggregate expressions; ``columns`` are the payload columns it reads and
    writes (the output keeps the names)."""

    name: str
    columns: tuple[str, ...]
    build: Callable[[DataFrame], list[Column]] = field(compare=False)
    fns: tuple[tuple[Callable, str], ...] = field(default=(), compare=False)   # of each column: a user's function and its type, see combine_columns

    @property
    def python(self) -> bool:
        return bool(self.fns)

    def aggs(self, df: DataFrame) -> list[Column]:
        return self.build(df)


def _sum_type(df: DataFrame, c: str) -> str:
    t = dict(df.dtypes)[c]
    # Java int arithmetic wraps; Spark's ANSI mode raises instead, so widen ints.
    return "bigint" if t in ("tinyint", "smallint", "int", "bigint") else "double"


def plus(*cols: str) -> Combiner:
    """Numeric sum per column (int/long into bigint, float into double).
    ``plus("val", "cnt")`` is the (sum, count) pair of G10."""
    return Combiner("plus", tuple(cols),
                    lambda df: [F.sum(F.col(c)).cast(_sum_type(df, c)).alias(c) for c in cols])


def array_plus(col: str, width: int) -> Combiner:
    """Element-wise sum of equal-length arrays. The width is known (a job parameter in
    the reference), so the sum is ``width`` plain sum columns rather than an explode.
    Arrays of another length make the job fail (the reference reports COMBINE_FAILED)."""

    def build(df: DataFrame) -> list[Column]:
        et = dict(df.dtypes)[col][len("array<"):-1]
        out_t = "bigint" if et in ("tinyint", "smallint", "int", "bigint") else "double"
        # One SQL expression for all the sums: a single call however wide the arrays are.
        sums = F.expr("array(" + ", ".join(f"sum(CAST(`{col}`[{i}] AS {out_t}))" for i in range(width)) + ")")
        ok = (F.min(F.size(col)) == width) & (F.max(F.size(col)) == width)
        return [F.when(ok, sums).otherwise(
            F.raise_error(F.lit(f"array_plus: arrays of a length other than {width}")).cast(f"array<{out_t}>")
        ).alias(col)]

    return Combiner("array_plus", (col,), build)


WIDE_BLOCK = 4096         # coordinates of a block
WIDE_HELD = 64 << 20      # bytes of sums a task holds before it passes them on


def sum_wide_arrays(df: DataFrame, key: str, col: str, width: int, block: int = WIDE_BLOCK, held: int = WIDE_HELD) -> DataFrame:
    """G8 for arrays of any width: ``(key, col)``, one element-wise sum per key (a null key is
    a key). The plan doesn't grow with the width: tasks add up whole Arrow batches and pass
    on partial sums in blocks of coordinates, blocks of one key meet by (key, block) and are
    added one by one, and a key's blocks are joined last. Arrays of another length, or with a
    null, make the job fail."""
    kind = dict(df.dtypes)[col][len("array<"):-1]
    out_t, np_t = ("bigint", np.int64) if kind in ("tinyint", "smallint", "int", "bigint") else ("double", np.float64)
    pa_t = pa.from_numpy_dtype(np_t)
    blocks = range(0, width, block)
    schema = T.StructType([df.schema[key], T.StructField("_block", T.IntegerType()), T.StructField("_sum", T.ArrayType(
        T.LongType() if out_t == "bigint" else T.DoubleType()))])

    def rows(sums: dict, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        for k, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(blocks), key_type), pa.array(range(len(blocks)), pa.int32()),
                 pa.array([v[i: i + block] for i in blocks], pa.list_(pa_t))], [key, "_block", "_sum"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, key_type = {}, None
        for b in batches:
            key_type = b.column(0).type
            lists = b.column(1).cast(pa.list_(pa_t))
            if lists.null_count or lists.flatten().null_count or (np.diff(lists.offsets.to_numpy()) != width).any():
                raise ValueError(f"array_plus: arrays of a length other than {width}")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            coded = b.column(0).dictionary_encode(null_encoding="encode")
            codes, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
            for c, name in enumerate(names):
                part = x[codes == c].sum(0, dtype=np_t)
                sums[name] = sums[name] + part if name in sums else part
                if len(sums) * width * 8 > held:
                    yield from rows(sums, key_type)
                    sums = {}
        yield from rows(sums, key_type)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, key_type = None, None, None
        done = lambda: pa.RecordBatch.from_arrays(
            [pa.array([at[0]], key_type), pa.array([at[1]], pa.int32()), pa.array([total], pa.list_(pa_t))], [key, "_block", "_sum"])
        for b in batches:
            key_type = b.column(0).type
            for k, n, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                v = v.values.to_numpy(zero_copy_only=False)
                if (k, n) == at:
                    total = total + v
                else:
                    if at is not None:
                        yield done()
                    at, total = (k, n), v
        if at is not None:
            yield done()

    parts = df.select(key, col).mapInArrow(partial, schema)
    met = parts.repartition(key, "_block").sortWithinPartitions(key, "_block").mapInArrow(final, schema)
    whole = met.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_block", "_sum"))).alias("_b"))
    return whole.select(key, F.flatten(F.transform("_b", lambda b: b["_sum"])).alias(col))


def together(*combiners: Combiner) -> Combiner:
    """Several combiners over disjoint payload columns, applied in one aggregate."""
    if len({cb.python for cb in combiners}) > 1:
        raise ValueError("a pandas UDF combiner can't share an aggregate with built-in ones")
    cols = tuple(c for cb in combiners for c in cb.columns)
    return Combiner("+".join(cb.name for cb in combiners), cols,
                    lambda df: [a for cb in combiners for a in cb.aggs(df)],
                    fns=tuple(f for cb in combiners for f in cb.fns))


def grouped_udf(fn: Callable, col: str, return_type: str) -> Combiner:
    """G6/G7 user value combiner, a function of a pandas Series.

    The function receives values of one id and must be associative, like the reference's
    ``combine(current, new)``: it is applied to the values that meet in a run of input rows
    first and then to those partial results, so no call ever sees more than ``HELD_ROWS`` rows.
    Ids are grouped whole batches at a time by Arrow; the function runs once per id that has
    something to combine, and once per id at the end. It is the slow path, kept for combiners
    that no built-in aggregate can express."""
    udf = F.pandas_udf(fn, return_type)
    return Combiner(f"udf:{getattr(fn, '__name__', 'fn')}", (col,), lambda df: [udf(F.col(col)).alias(col)],
                    fns=((fn, return_type),))


def concat_lists(*tables: DataFrame) -> DataFrame:
    """G12 (list concatenation per id): lists stay flat rows, one (id, element) each, so
    the lists of several tables are concatenated by a bag union; a hot id's list is never
    one row."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


LIST_MOST = 4096   # elements of one row's list


def lists_by_key(df: DataFrame, key: str, val: str, part: Column, most: int = LIST_MOST) -> DataFrame:
    """G12 with the lists kept: ``(key, chunk, vals)``, a key's elements in ascending order, in
    rows of at most ``most``, so that a hot key's list is many rows of bounded size. ``part``
    is a coarse, order-preserving part of ``val`` (such as ``val div 100000``): a key's rows
    are numbered within it, so no task sorts a whole key."""
    from corvid.operators.keyed import numbered  # the operators use this module

    rows = numbered(df.select(key, val, part.alias("_part")), [key], "_part", [val], "_at")
    chunk = F.floor(F.col("_at") / F.lit(most)).cast("int").alias("chunk")
    lists = rows.groupBy(key, chunk).agg(F.array_sort(F.collect_list(F.struct("_at", val))).alias("_l"))
    return lists.select(key, "chunk", F.transform("_l", lambda x: x[val]).alias("vals"))


def int_div(num: str, den: str) -> Column:
    """G11 finish step: integer division truncating toward zero (Java ``/``), which is
    Spark's ``div``."""
    return F.expr(f"`{num}` div `{den}`")


HELD_ROWS = 1 << 19    # rows that a task combines at once
HELD_BYTES = 64 << 20  # or their bytes, if that is fewer rows
_VALUES = (T.IntegralType, T.FractionalType, T.StringType, T.BinaryType, T.BooleanType, T.DateType)
_KEYS = (*_VALUES, T.TimestampType, T.TimestampNTZType)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches as tables of bounded size."""
    held, rows, size = [], 0, 0
    for b in batches:
        if b.num_rows:
            held, rows, size = [*held, b], rows + b.num_rows, size + b.nbytes
        if rows >= HELD_ROWS or size >= HELD_BYTES:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _results(got: list, kind: pa.DataType) -> pa.Array:
    try:
        return pa.array(got, kind, from_pandas=True)
    except (pa.ArrowInvalid, pa.ArrowTypeError):  # a whole float for an integer type, say
        return pa.concat_arrays([pa.Array.from_pandas(pd.Series([x]), type=kind) for x in got])


def _combined(t: pa.Table, keys: Sequence[str], cols: Sequence[str], fns: Sequence[Callable], out: pa.Schema, every: bool) -> pa.Table:
    """One row per key, in the order in which the keys come: the functions of the key's values.
    A key with one row keeps its values as they are, unless ``every``."""
    lists = t.group_by(list(keys), use_threads=False).aggregate([(c, "list") for c in cols])
    done = [lists.column(k).combine_chunks().cast(out.field(k).type) for k in keys]
    for c, fn in zip(cols, fns):
        met = lists.column(f"{c}_list").combine_chunks()
        offsets, values, kind = met.offsets.to_numpy(), met.values, out.field(c).type
        which = np.arange(len(met)) if every else np.flatnonzero(np.diff(offsets) > 1)
        plain = values.to_pandas().to_numpy() if not values.null_count else None
        series = (lambda a, b: pd.Series(plain[a:b])) if plain is not None else lambda a, b: values.slice(a, b - a).to_pandas()
        got = _results([fn(series(a, b)) for a, b in zip(offsets[which].tolist(), offsets[which + 1].tolist())], kind)
        if not every:  # the first value of each key, or, from ``got``, what its values come to
            at = offsets[:-1].astype("int64")
            at[which] = len(values) + np.arange(len(which))
            got = pa.concat_arrays([values.cast(kind), got]).take(pa.array(at))
        done.append(got)
    return pa.Table.from_arrays(done, schema=out)


def _combine_in_tasks(combiner: Combiner, keys: Sequence[str], df: DataFrame) -> DataFrame:
    """Rows that meet in a task are combined there, a bounded run at a time; what is left goes to
    its key's task, sorted by key, and is combined run by run again (a key that goes on in the
    next run takes its result along)."""
    cols, fns = combiner.columns, [fn for fn, _ in combiner.fns]
    given = {f.name: f.dataType for f in df.schema}
    types = [T._parse_datatype_string(t) for _, t in combiner.fns]
    schema = T.StructType([T.StructField(k, given[k]) for k in keys] + [T.StructField(c, t) for c, t in zip(cols, types)])
    out = to_arrow_schema(schema)
    every = any(given[c] != t for c, t in zip(cols, types))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _held(batches):
            yield from _combined(t, keys, cols, fns, out, every).to_batches(1 << 16)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row = None
        for t in _held(batches):
            t = t.cast(out)
            t = _combined(t if open_row is None else pa.concat_tables([open_row, t]), keys, cols, fns, out, True)
            open_row = t.slice(t.num_rows - 1)
            yield from t.slice(0, t.num_rows - 1).to_batches(1 << 16)
        if open_row is not None:
            yield from open_row.to_batches()

    # Keys that Spark holds equal get the same bits, as in its own grouping.
    same = [F.when(F.isnan(k), F.lit(float("nan"))).when(F.col(k) == 0, F.lit(0.0)).otherwise(F.col(k)).cast(given[k]).alias(k)
            if isinstance(given[k], (T.FloatType, T.DoubleType)) else F.col(k) for k in keys]
    parts = df.select(*same, *cols).mapInArrow(first, schema)
    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(final, schema)


def combine_columns(combiner: Combiner | None, keys: Sequence[str], df: DataFrame) -> DataFrame:
    if combiner is None:
        return df
    if combiner.python:
        given = {f.name: f.dataType for f in df.schema}
        if all(isinstance(given.get(k), _KEYS) for k in keys) and all(isinstance(given.get(c), _VALUES) for c in combiner.columns) and all(
                isinstance(T._parse_datatype_string(t), _VALUES) for _, t in combiner.fns):
            return _combine_in_tasks(combiner, keys, df)
        part = df.withColumn("_part", F.spark_partition_id())  # types whose Series are Spark's to make
        df = part.groupBy(*keys, "_part").agg(*combiner.aggs(part)).drop("_part")
    return df.groupBy(*keys).agg(*combiner.aggs(df))
