"""A stored global table that is pushed into (J2): rows live in buckets by key hash, and a push
rewrites only the buckets that get rows.

The table is Parquet partitioned by bucket. A push combines the local rows first (a hot key
becomes one row), reads the buckets they fall into, merges and overwrites just those
partitions; the files of all other buckets stay as they are. Bucket numbers reach the driver,
at most as many as the table has buckets. A push writes beside the table and moves whole
buckets in when all tasks are done; lost tasks repeat. One push at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.combiners import Combiner
from corvid.operators import keyed

BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def create(table: DataFrame, path: str, key: str, combiner: Combiner | None, buckets: int) -> None:
    """Store ``table`` (equal keys combined) in ``buckets`` buckets."""
    rows = keyed.combine_by_id(table, key, combiner).withColumn(BUCKET, bucket_of(key, buckets))
    rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored table; ``schema`` names its columns, so an empty table reads as well."""
    return spark.read.schema(f"{schema}, {BUCKET} int").parquet(path).drop(BUCKET)


def push(spark: SparkSession, path: str, local: DataFrame, key: str, combiner: Combiner, buckets: int) -> list[int]:
    """Merge ``local`` into the table at ``path``: known keys are combined into their
    row, new keys are inserted. ``buckets`` as at its creation. Returns the rewritten buckets."""
    mine = keyed.combine_by_id(local, key, combiner).withColumn(BUCKET, bucket_of(key, buckets))
    touched = sorted(r[0] for r in mine.select(BUCKET).distinct().collect())
    if not touched:
        return []
    schema = ", ".join(f"`{c}` {t}" for c, t in mine.dtypes)
    old = spark.read.schema(schema).parquet(path).filter(F.col(BUCKET).isin(touched))
    merged = keyed.combine_by_id(old.unionByName(mine), [BUCKET, key], combiner)
    (merged.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
    return touched
