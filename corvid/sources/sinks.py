"""Writers for the reference's text outputs (S6, S7); S8 lives with the forest plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_ranks(ranks: DataFrame, path: str) -> None:
    """``page \\t rank`` lines, pages ascending (range-partitioned sort, so the part
    files concatenate in order). The MPI program's extra ``null`` line is not written."""
    ranks.select("page", "rank").orderBy("page").write.mode("overwrite").csv(path, sep="\t")


def centroid_lines(centroids: DataFrame) -> DataFrame:
    """S7 line format: every value followed by a tab."""
    vals = F.transform(F.col("center"), lambda x: F.concat(x.cast("string"), F.lit("\t")))
    return centroids.orderBy("cid").select(F.array_join(vals, "").alias("value"))


def write_centroids(centroids: DataFrame, path: str) -> None:
    """One line per centroid, by ``cid``."""
    centroid_lines(centroids).write.mode("overwrite").text(path)
