"""A training corpus from raw documents, in five stages.

1. quality rules: documents that fail the base rule or the isolation forest go;
2. SimHash near-dedup: the document with the smallest id of each group stays;
3. substring dedup: words inside windows of 50 that an earlier document has are cut out of
   the texts; documents of which nothing is left go;
4. mixing: documents are taken as often as their source's target weight says;
5. SentencePiece: every text is encoded by a sampled segmentation, which decodes losslessly.

Each stage gets what its predecessor kept, reread from Parquet in the shared folder that
``spark.checkpoint.dir`` names. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corvid.llm import mixing, quality, sentencepiece, simhash, substring
from corvid.llm.common import table
from corvid.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.survivors(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.cut_documents(docs, size_col="n_chars" if "n_chars" in docs.columns else None)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def sentencepiece_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("sentencepiece_encode", sentencepiece_encode),
]

#: The forest, the fingerprints and the sampled encoding are beyond SQL: the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{base}/{k}_{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
