"""Text readers for the reference's positional formats.

All readers are plain ``spark.read.text`` scans followed by column expressions, so a
file is split across tasks like any other text input. Where the format needs the line
number (centroid ids, example ids, "last line wins"), :func:`with_line_index` derives it
from the split each row came from, never by reading a whole file in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Java's Scanner and String.split("\\s+") both treat these as token separators.
_WS = r"[ \t\n\x0B\f\r]+"


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_many(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One text scan over a list of files (each line one row, ``value``)."""
    return spark.read.text(_paths(paths))


def with_line_index(df: DataFrame, col: str = "line_no") -> DataFrame:
    """Add a 0-based line number, in file order (files by path, then position).

    A scan row knows its file and the byte offset of its split; within a split the
    monotonically increasing id follows line order. Per-split counts (one row per split,
    a table whose size is data size / split size) give each split its starting offset,
    so only that small table is ordered in one place. Whether it is broadcast back is
    left to adaptive execution, which measures its size first.
    """
    keyed = df.select("*", F.col("_metadata.file_path").alias("_f"),
                      F.col("_metadata.file_block_start").alias("_b"),
                      F.monotonically_increasing_id().alias("_m"))
    splits = keyed.groupBy("_f", "_b").agg(F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    order = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_f", "_b", "_m0", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_off"))
    out = keyed.join(splits, ["_f", "_b"])
    return out.select(*df.columns, (F.col("_off") + F.col("_m") - F.col("_m0")).alias(col))


def _int_tokens(value: Column) -> Column:
    """Whitespace tokens parsed as 64-bit ints, cut at the first token that is not an int. An
    int beyond 64 bits raises."""
    wide = lambda t: F.when(t.rlike("^[+-]?[0-9]+$"), F.raise_error(F.concat(F.lit("beyond 64 bits: "), t)).cast("bigint"))
    toks = F.split(F.regexp_replace(value, f"^{_WS}|{_WS}$", ""), _WS)
    # A lambda's variable holds the parsed list, so it is computed once however often it is read.
    parsed = F.transform(F.array(F.transform(toks, lambda t: F.coalesce(t.try_cast("bigint"), wide(t)))), _leading)
    return parsed[0]


def _leading(ints: Column) -> Column:
    """The list up to its first null."""
    stop = F.array_position(F.transform(ints, lambda x: x.isNull()), True)
    return F.when(stop == 0, ints).otherwise(F.slice(ints, 1, F.greatest(stop - 1, F.lit(0))))


def read_adjacency(spark: SparkSession, path: str | Sequence[str], duplicates: str = "last") -> DataFrame:
    """``node target target ...`` per line -> ``(src bigint, dst array<bigint>)``.

    A line whose first token is not an int (a blank line included) raises, like the
    reference. A node listed twice keeps its last line (``duplicates="last"``); pass
    ``"assume_unique"`` to skip the shuffle that resolves repeats, or ``"union"`` if a node's
    list is cut into several lines: each stays a row (for :func:`corvid.operators.graph.edges`).
    """
    lines = spark.read.text(_paths(path))
    if duplicates == "last":
        lines = with_line_index(lines)
    return parse_adjacency(lines, duplicates)


def parse_adjacency(lines: DataFrame, duplicates: str = "last", value: str = "value", line_no: str = "line_no") -> DataFrame:
    """S1 on a column of lines (numbered by ``line_no`` for ``duplicates="last"``)."""
    fail = F.raise_error(F.concat(F.lit("adjacency line without a node id: "), F.col(value))).cast("bigint")
    row = F.transform(F.array(_int_tokens(F.col(value))), lambda t: F.struct(
        F.when(F.size(t) > 0, t[0]).otherwise(fail).alias("src"), F.slice(t, 2, F.size(t)).alias("dst")))
    last = [F.col(line_no).alias("line_no")] if duplicates == "last" else []
    parsed = lines.select(F.explode(row).alias("_r"), *last).select("_r.src", "_r.dst", *(["line_no"] if last else []))
    if duplicates == "last":
        parsed = parsed.groupBy("src").agg(F.max_by("dst", "line_no").alias("dst"))
    elif duplicates not in ("assume_unique", "union"):
        raise ValueError(f"duplicates must be 'last', 'assume_unique' or 'union', not {duplicates!r}")
    return parsed.select("src", "dst")


def _double_vector(value: Column, dim: int, what: str) -> Column:
    # Java's split drops trailing empty strings but keeps a leading one.
    toks = F.split(F.regexp_replace(value, _WS + "$", ""), _WS)
    vals = F.transform(toks, lambda t: t.try_cast("double"))
    ok = (F.size(vals) == dim) & F.forall(vals, lambda x: x.isNotNull())
    return F.when(ok, vals).otherwise(
        F.raise_error(F.concat(F.lit(f"{what}: expected {dim} numbers in line: "), value)).cast("array<double>"))


def read_vectors(spark: SparkSession, paths: str | Sequence[str], dim: int) -> DataFrame:
    """Whitespace doubles of a fixed width -> ``(point_id long, features array<double>)``.

    A row of the wrong width aborts the job. ``point_id`` is unique but carries no order.
    """
    lines = spark.read.text(_paths(paths))
    return lines.select(F.monotonically_increasing_id().alias("point_id"), parse_vector(F.col("value"), dim).alias("features"))


def parse_vector(value: Column, dim: int) -> Column:
    """S2 / S3 on a column of lines."""
    return _double_vector(value, dim, "vector")


def read_centroids(spark: SparkSession, path: str | Sequence[str], dim: int) -> DataFrame:
    """S3: like S2; ``cid`` is the 0-based line number, count slot ``n`` starts at 0."""
    lines = with_line_index(spark.read.text(_paths(path)))
    return lines.select(F.col("line_no").cast("int").alias("cid"),
                        _double_vector(F.col("value"), dim, "centroid").alias("center"),
                        F.lit(0).cast("long").alias("n"))


def _labelled_rows(lines: DataFrame, value: str, example: str) -> DataFrame:
    toks = _int_tokens(F.regexp_replace(F.col(value), ":", " "))
    rows = lines.select(F.col(example).cast("long").alias("example"), toks.alias("_t"))
    return rows.select("example", F.when(F.size("_t") > 0, F.col("_t")[0]).otherwise(
        F.raise_error(F.lit("labelled line without a label")).cast("bigint")).alias("label"),
        F.slice("_t", 2, F.size("_t")).alias("_f"))


def parse_sparse_labeled(lines: DataFrame, value: str = "value", example: str = "line_no") -> tuple[DataFrame, DataFrame]:
    """S4 on already indexed lines: ``label tok tok ...``; ``:`` is a separator, so in
    ``f:v`` the value ``v`` is a feature too; negative ids become positive; repeated
    tokens are kept. Returns ``(labels(example, label), postings(feature, example))``.
    """
    rows = _labelled_rows(lines, value, example)
    labels = rows.select("example", "label")
    postings = rows.select(F.explode("_f").alias("feature"), "example").select(
        F.abs("feature").alias("feature"), "example")
    return labels, postings


def labelled_postings(lines: DataFrame, value: str = "value", example: str = "line_no") -> DataFrame:
    """S4 in one pass: ``(example, feature, label)`` per token, no join back to labels."""
    toks = _int_tokens(F.regexp_replace(F.col(value), ":", " "))
    fail = F.raise_error(F.lit("labelled line without a label")).cast("array<struct<feature:bigint,label:bigint>>")
    rows = F.transform(F.array(toks), lambda t: F.when(F.size(t) == 0, fail).otherwise(
        F.transform(F.slice(t, 2, F.size(t)), lambda f: F.struct(F.abs(f).alias("feature"), t[0].alias("label")))))
    return lines.select(F.col(example).cast("long").alias("example"), F.explode(F.flatten(rows)).alias("_r")).select(
        "example", "_r.feature", "_r.label")


def read_sparse_labeled(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """S4 from text files; example id = 0-based line index."""
    return parse_sparse_labeled(with_line_index(spark.read.text(_paths(path))))
