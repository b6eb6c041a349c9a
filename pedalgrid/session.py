"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on; cluster settings are left to spark-submit."""
    builder = (
        SparkSession.builder.appName("pedalgrid")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # No call sites per column expression: plans of many columns are built faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local master without that setting."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="pedalgrid-")
    raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/pedalgrid/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several consumers need one result. The table survives lost executors and gives
    Catalyst real sizes for the joins that follow.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
