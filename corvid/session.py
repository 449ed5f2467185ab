"""Session helpers: building a session, finding the shared checkpoint folder, cutting lineage.

Iterative jobs (PageRank, K-means, forest growth) cut their lineage with reliable
``checkpoint()`` into the folder named by ``spark.checkpoint.dir``. On a cluster that
setting must point at shared storage; only a local-mode session without it (tests,
bench) gets a fresh scratch folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "corvid", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the context). Only in
    local mode, where executors share the driver's disk, is a scratch folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="corvid-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def persist(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def child_session(spark: SparkSession) -> SparkSession:
    """A session with the same SQL settings on the same context: settings changed there
    don't reach the plans of the caller's queries."""
    child = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and v is not None and spark.conf.isModifiable(k):
            child.conf.set(k, v)
    return child


def in_session(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``df`` as a table of another session of the same context."""
    name = f"corvid_{uuid.uuid4().hex}"
    # The projection keeps a cached ``df`` cached when the view goes.
    df.select("*").createGlobalTempView(name)
    try:
        return spark.table(f"{spark.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)
