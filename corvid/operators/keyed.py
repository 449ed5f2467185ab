"""Keyed tables and their collectives.

The reference keeps, on every worker, a table of partitions keyed by an int id whose
rows merge through a combiner when ids meet, and moves those tables with collectives
(push, pull, regroup, reduce, allreduce, allgather, broadcast). In Spark a keyed table
is a DataFrame with a key column and payload columns; "workers" are not data, and every
collective is one of: union, ``groupBy(key).agg(combiner)``, an equi join, or a size-
checked broadcast. Where a caller wants to keep the reference's notion of which worker
holds a row, an ``owner`` column carries it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions.combiners import Combiner, combine_columns

# --------------------------------------------------------------------------- placement


def partition_of(col: str | Column, n: int) -> Column:
    """The reference's default partitioner, ``abs(id % n)`` (Java remainder)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.abs(c % F.lit(n)).cast("int")


def kv_partition_id(col: str | Column, kind: str = "int") -> Column:
    """Partition id of a key: an int key is itself, a long key its low 32 bits (as a
    signed int), any other key a hash. Only placement depends on it, never a result."""
    c = F.col(col) if isinstance(col, str) else col
    if kind == "int":
        return c.cast("int")
    if kind == "long":
        low = F.pmod(c, F.lit(1 << 32))
        return F.when(low >= F.lit(1 << 31), low - F.lit(1 << 32)).otherwise(low).cast("int")
    return F.hash(c)


def rotate_owner(df: DataFrame, n: int, owner: str = "owner", rotate_map: dict[int, int] | None = None) -> DataFrame:
    """P10: every owner's rows move to the next owner (the last wraps to 0), or to
    ``rotate_map[owner]``; with one worker nothing moves. A relabel, not a shuffle."""
    if rotate_map is None:
        new = F.lit(0) if n <= 1 else F.pmod(F.col(owner) + 1, F.lit(n))
    else:
        m = F.create_map(*[F.lit(x) for kv in sorted(rotate_map.items()) for x in kv])
        new = F.coalesce(m[F.col(owner)], F.col(owner))
    return df.withColumn(owner, new.cast("int"))


# ----------------------------------------------------------------------- single table


def reject_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adding a null partition, key or value fails in the reference; here such rows
    are simply not added."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def combine_by_id(df: DataFrame, key: str | Sequence[str], combiner: Combiner | None) -> DataFrame:
    """G1: rows with the same id merge through the combiner (partial + final aggregate)."""
    keys = [key] if isinstance(key, str) else list(key)
    return combine_columns(combiner, keys, df)


def add(table: DataFrame, rows: DataFrame, key: str, combiner: Combiner | None) -> DataFrame:
    """Table.add: union new rows in; an id already present is combined."""
    return combine_by_id(table.unionByName(rows), key, combiner)


def get_val(table: DataFrame, keys: DataFrame, key: str, default: dict | None = None) -> DataFrame:
    """P5: look up ``keys`` in ``table``; a missing id gets ``default`` (null otherwise).
    A null that the table holds stays null."""
    out = keys.select(key).join(table.withColumn("_held", F.lit(True)), key, "left")
    for c, v in (default or {}).items():
        out = out.withColumn(c, F.when(F.col("_held"), F.col(c)).otherwise(F.lit(v)))
    return out.drop("_held")


def remove_val(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Drop the given ids (anti join)."""
    return table.join(keys.select(key).distinct(), key, "left_anti")  # a hot key is one row


def ids(table: DataFrame, key: str) -> DataFrame:
    """The ids held by a table."""
    return table.select(key)


def is_empty(table: DataFrame) -> bool:
    """Emptiness; a one-row probe, not a count."""
    return table.isEmpty()


def apply_function(table: DataFrame, fn: Callable[[DataFrame], DataFrame] | dict[str, Column]) -> DataFrame:
    """Run a function on every payload in place: column expressions (kept inside
    codegen), or a DataFrame -> DataFrame function (e.g. one using ``mapInPandas``)."""
    if isinstance(fn, dict):
        return table.withColumns(fn)
    return fn(table)


def numbered(df: DataFrame, keys: Sequence[str], part: str, order: Sequence[str], number: str = "number",
             size: str | None = None) -> DataFrame:
    """Rows numbered from 0 within their keys, by (``part``, ``order``); ``size`` adds the
    number of rows of the keys. Rows are numbered within (keys, part), so a hot key is spread
    over its parts; where each part starts comes from a table of one row per (keys, part)."""
    by = [*keys, part]
    spread = Window.partitionBy(*by).orderBy(*order)
    rows = df.withColumn(number, (F.row_number().over(spread) - 1).cast("bigint"))
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                          *([F.sum("_n").over(whole).alias(size)] if size else []))
    return rows.join(start, by).withColumn(number, F.col(number) + F.col("_start")).drop("_start").select(
        *df.columns, number, *([size] if size else []))


# ------------------------------------------------------------------------ collectives


def regroup(table: DataFrame, key: str, combiner: Combiner | None, n: int | None = None,
            owner: str = "owner") -> DataFrame:
    """Move rows to ``abs(id % n)`` and combine on arrival. The combine is a
    partial+final aggregate, so a hot id is reduced before the exchange; the owner the
    reference would place it on is kept as a column (``repartition(n, owner)`` afterwards
    places it physically, one row per id, so without skew)."""
    out = combine_by_id(table, key, combiner)
    if n is not None:
        numeric = dict(table.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
        # A non-numeric key is placed by its hash (P9), then by the same partitioner.
        out = out.withColumn(owner, partition_of(key if numeric else kv_partition_id(key, "object"), n))
    return out


def regroup_aggregate(table: DataFrame, key: str, combiner: Combiner | None,
                      fn: Callable[[DataFrame], DataFrame] | dict[str, Column], n: int | None = None) -> DataFrame:
    """Regroup, then apply a function to every combined row."""
    return apply_function(regroup(table, key, combiner, n), fn)


def aggregate(table: DataFrame, key: str, combiner: Combiner | None,
              fn: Callable[[DataFrame], DataFrame] | dict[str, Column]) -> DataFrame:
    """G15 whose result every worker sees. A DataFrame result is visible to every
    later task already; broadcast it at the join that needs it (:func:`checked_broadcast`)."""
    return regroup_aggregate(table, key, combiner, fn)


def reduce(tables: Sequence[DataFrame] | DataFrame, key: str, combiner: Combiner | None,
           root: int = 0, owner: str = "owner") -> DataFrame:
    """All workers' tables merged into the root's; the others end empty (the result
    holds only the root's rows, labelled with ``owner = root``)."""
    merged = allreduce(tables, key, combiner, owner=owner)
    return merged.withColumn(owner, F.lit(root).cast("int"))


def allreduce(tables: Sequence[DataFrame] | DataFrame, key: str, combiner: Combiner | None,
              owner: str = "owner") -> DataFrame:
    """Every worker ends with the merged table. ``tables`` is a list of per-worker
    DataFrames or one DataFrame with an ``owner`` column (dropped)."""
    df = _union(tables)
    if owner in df.columns:
        df = df.drop(owner)
    return combine_by_id(df, key, combiner)


def allgather(tables: Sequence[DataFrame] | DataFrame, key: str, combiner: Combiner | None,
              owner: str = "owner") -> DataFrame:
    """The union of all tables, equal ids combined, seen by every worker."""
    return allreduce(tables, key, combiner, owner=owner)


def gather(tables: Sequence[DataFrame] | DataFrame) -> DataFrame:
    """All rows at one place, no combining (a bag union)."""
    return _union(tables)


def push(local: DataFrame, global_: DataFrame, key: str, combiner: Combiner | None, owner: str = "owner") -> DataFrame:
    """Upsert-merge local rows into the global table: known ids are combined into
    the global row, new ids are inserted."""
    if owner in local.columns:
        local = local.drop(owner)
    return combine_by_id(global_.unionByName(local), key, combiner)


def pull(local: DataFrame, global_: DataFrame, key: str, combiner: Combiner | None, owner: str | None = "owner",
         on_missing: str = "error", use_bcast: bool | None = None, bcast_bytes: int = 64 << 20) -> DataFrame:
    """Every local row fetches the global row of its id and *adds* it (the local value
    is not replaced). A local id missing from the global table fails the job
    (``on_missing="error"``, as the reference) or keeps its local value (``"keep"``).

    With an ``owner`` column each worker's copy is pulled separately. ``use_bcast`` hints
    a broadcast of the global side; by default Spark decides from its measured size.
    """
    groups = [key] + ([owner] if owner and owner in local.columns else [])
    payload = [c for c in local.columns if c not in groups]
    mine = combine_by_id(local, groups, combiner)
    g = global_.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_g_{c}") for c in payload], F.lit(True).alias("_known"))
    g = checked_broadcast(g, bcast_bytes) if use_bcast else g
    met = mine.join(g, F.col(key) == F.col("_key"), "left")
    if on_missing == "error":
        # The check is a filter on the key: no projection or count can prune it away.
        fail = F.raise_error(F.concat(F.lit("pull: id missing from the global table: "), F.col(key).cast("string")))
        met = met.filter(F.when(F.coalesce(F.col("_known"), F.lit(False)), F.lit(True)).otherwise(fail.cast("boolean")))
    if combiner is None:
        return met.select(*groups, *payload)
    # The pair (local row, fetched row) is two rows of one id for the combiner.
    pair = F.array(F.struct(*[F.col(c).alias(c) for c in payload], F.lit(True).alias("_use")),
                   F.struct(*[F.col(f"_g_{c}").alias(c) for c in payload], F.coalesce(F.col("_known"), F.lit(False)).alias("_use")))
    rows = met.select(*groups, F.explode(pair).alias("_r")).filter(F.col("_r._use")).select(
        *groups, *[F.col(f"_r.{c}").alias(c) for c in payload])
    return combine_by_id(rows, groups, combiner)


def join_to_static(dynamic: DataFrame, static: DataFrame, key: str, combiner: Combiner | None,
                   keep_unmatched: bool = True) -> DataFrame:
    """Co-location join. Dynamic rows go to the holder of their id in the static table
    and rows that arrive with one id are combined; static rows keep their own columns.
    ``keep_unmatched`` keeps dynamic ids that have no static row (full outer join)."""
    combined = combine_by_id(dynamic, key, combiner)
    return static.join(combined, key, "full" if keep_unmatched else "left")


_FIXED = {"boolean": 8, "tinyint": 8, "smallint": 8, "int": 8, "bigint": 8, "float": 8, "double": 8, "date": 8, "timestamp": 8}


def row_bound(df: DataFrame) -> int | None:
    """Bytes of a broadcast row at most; None if a column has no fixed width."""
    widths = [_FIXED.get(t) for _, t in df.dtypes]
    return None if None in widths else 64 + sum(widths)


def checked_broadcast(df: DataFrame, max_bytes: int, rows: int | None = None, row_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only when the side is provably small: ``rows`` (counted here
    when not given) times an upper bound on the row size (``row_bytes``, else from the
    column types; rows with strings or arrays have none and are not hinted). Otherwise the
    DataFrame is returned as is and Spark shuffles (or adaptive execution broadcasts it
    after measuring it)."""
    width = row_bytes or row_bound(df)
    if width is None:
        return df
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * width <= max_bytes else df


def _union(tables: Sequence[DataFrame] | DataFrame) -> DataFrame:
    if isinstance(tables, DataFrame):
        return tables
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
