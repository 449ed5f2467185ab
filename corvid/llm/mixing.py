"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions
only).

Targets: the sources in code-point order (null last) have the weights 5, 2, 1, repeating,
and share a budget (by default all words) by weight; no source gets more than
``max_epochs`` times its own words, and what is cut off is shared again by weight until no
source is above. That water level is found in closed form: with the sources in order of
cap per weight, sources are full up to the first one whose cap per weight is above the
level that remains for it and all after it.

Sampling: a source takes every document floor(target / source words) times (complete
epochs). The rest of its target is filled in the order of the documents' exponential keys
``-ln(u) / quality weight`` (u a uniform hash of the id), by running sum of words; a
document is taken if the budget reaches the middle of it, so a source ends within half a
document of its target.

No source is sorted whole: keys are cut into ``BUCKETS`` even ranges of their distribution in the
table, which is known from the counted quality weights, so a range holds about 1 / ``BUCKETS`` of
all documents whatever their weights are. The words per (source, range) give each range's start,
and only the one range that holds the end of the budget is sorted, so a source with a third of all
rows is no larger task than any other. The per-source table (a row per source) is broadcast when its counted rows
are at most ``BROADCAST_SOURCES``, else joined.

Null text: size 0, taken 0 words. Null source: a source of its own. Null id: hashed as an
empty string. Ties in the key: by id; equal rows with one id are taken in any order, which
is the same result. A source without words has target 0. An empty table gives an empty
result. Extra columns are kept by ``mixed_documents`` and not read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import fresh
from corvid.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
BUCKETS = 4096
BROADCAST_SOURCES = 10_000
SEED = "corvid-mix"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text: words become one letter each, then the
    separators go."""
    ones = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(ones, r"[\x20\x09-\x0D]+", "")).cast("bigint")


def quality_weight(text: Column, size: Column) -> Column:
    """A document's weight in the fractional epoch: half for short documents, and half
    again for unusually short or long words on average."""
    mean = F.length(F.coalesce(text, F.lit(""))) / F.greatest(size, F.lit(1))
    return (F.when(size >= 50, 1.0).otherwise(0.5) * F.when(mean.between(3, 12), 1.0).otherwise(0.5))


#: The values that ``quality_weight`` takes.
QUALITIES = (1.0, 0.5, 0.25)


def key_range(key: Column, shares: list[float], buckets: int) -> Column:
    """The range of an exponential key: ``F(key) * buckets`` for the distribution function F of
    a table in which ``shares[i]`` of the documents have the weight ``QUALITIES[i]``. It grows
    with the key, so ranges keep the keys' order."""
    below = sum((F.lit(p) * (1 - F.exp(-w * key)) for w, p in zip(QUALITIES, shares)), F.lit(0.0))
    return F.least(F.floor(below * buckets), F.lit(buckets - 1)).cast("int")


def uniform(id_col: Column, seed: str = SEED) -> Column:
    """A uniform number in (0, 1) from an id: 52 bits of its MD5."""
    h = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit(""))))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                   budget: int | None = None) -> DataFrame:
    """``(source, source_size, weight, target)`` from rows with ``source`` and ``size``."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    rank = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank + 1).cast("int")))
    s = s.withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    total = F.sum("source_size").over(everything) if budget is None else F.lit(budget)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    s = s.withColumn("level", level).withColumn("place", F.row_number().over(by_cap))
    not_full = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct("place", "level"))
    s = s.withColumn("free", F.min(not_full).over(everything))
    target = F.when(F.col("free").isNull() | (F.col("place") < F.col("free.place")),
                    F.col("cap").cast("double")).otherwise(F.col("free.level") * F.col("weight"))
    return s.select("source", "source_size", "weight", target.alias("target"))


def _joined(rows: DataFrame, small: DataFrame, few: bool, *keys: str) -> DataFrame:
    """Null-safe equi join on ``keys``; the small side is broadcast if it was counted few."""
    side = small.select(*[F.col(k).alias(f"_s_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    return rows.join(F.broadcast(side) if few else side, on).drop(*[f"_s_{k}" for k in keys])


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, buckets: int = BUCKETS,
        budget: int | None = None, seed: str = SEED, row: Column | None = None) -> DataFrame:
    """One row per input row: ``(doc_id, size, source_size, target, taken)``; with ``row``
    also that expression as ``row_key``."""
    size = word_count(F.col(text_col).cast("string"))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
                         F.col(text_col).cast("string").alias("_t"),
                         (F.lit(None).cast("bigint") if row is None else row).alias("row_key"))
    weight = quality_weight(F.col("_t"), F.col("size"))
    key = -F.log(uniform(F.col("doc_id"), seed)) / weight
    sized = cut_lineage(narrow.select("doc_id", "source", "size", "row_key", key.alias("key"), weight.alias("_w")))
    counted = sized.agg(*[F.avg((F.col("_w") == w).cast("double")).alias(f"p{i}") for i, w in enumerate(QUALITIES)]).first()
    sized = sized.drop("_w")
    targets = cut_lineage(source_targets(sized, weights, max_epochs, budget))
    few = targets.count() <= BROADCAST_SOURCES
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("epochs", F.least(epochs, F.lit(max_epochs)).cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    rows = sized.withColumn("bucket", key_range(F.col("key"), [p or 0.0 for p in counted], buckets))
    ranges = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = _joined(ranges.withColumn("until", F.sum("words").over(upto)), plan, few, "source")
    edge = ranges.filter((F.col("until") - F.col("words") < F.col("rest")) & (F.col("until") >= F.col("rest"))).groupBy(
        "source").agg(F.min(F.struct("bucket", (F.col("until") - F.col("words")).alias("before"))).alias("e"))
    plan = _joined(plan, edge.select("source", F.col("e.bucket").alias("edge"), F.col("e.before").alias("before")).unionByName(
        targets.select("source", F.lit(None).cast("int").alias("edge"), F.lit(None).cast("bigint").alias("before"))).groupBy(
        "source").agg(F.max("edge").alias("edge"), F.max("before").alias("before")), few, "source")
    rows = _joined(rows, plan, few, "source")
    at_edge = F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    until = F.col("before") + F.sum("size").over(order)
    sorted_rows = rows.filter(at_edge).withColumn("more", until - F.col("size") / 2 <= F.col("rest"))
    other = rows.filter(~at_edge).withColumn("more", F.coalesce(F.col("bucket") < F.col("edge"), F.lit(False)))
    out = sorted_rows.unionByName(other)
    taken = (F.col("epochs") + F.col("more").cast("bigint")) * F.col("size")
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), *["row_key"] * (row is not None))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is
    taken (texts without words are not)."""
    row = F.xxhash64(*docs.columns)
    m = mix(docs, id_col, text_col, source_col, row=row, **options)
    mid, mrow, here, times, nth = (fresh(docs, c) for c in ("_m_id", "_m_row", "_row", "_copies", "_n"))
    side = m.filter(F.col("taken") > 0).groupBy(F.col("doc_id").alias(mid), F.col("row_key").alias(mrow)).agg(
        F.sum(F.expr("taken div size")).alias(times))
    once = docs.withColumn(here, row).dropDuplicates([id_col, here])
    met = once.join(side, F.col(id_col).eqNullSafe(F.col(mid)) & (F.col(here) == F.col(mrow)))
    return met.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times)))).select(*docs.columns)
