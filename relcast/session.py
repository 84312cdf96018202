"""Session helpers: building a session and finding shared scratch space.

Scratch data (staged files, materialised intermediates) always lives under the
folder the cluster names in ``spark.checkpoint.dir``; a local folder is only
chosen when the session has none, which is the case in unit tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "relcast") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate data, derived from the checkpoint dir.

    Reads the session's checkpoint directory. Where none is configured, one is
    created under the system temp folder in local mode (tests); on a cluster
    that folder would exist on the driver only, so this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not _single_machine(sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="relcast-ckpt-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def _single_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the shared work root."""
    return f"{work_root(spark)}/relcast/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a location, as the JVM sees it."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once,
    lineage cut, and the planner knows its true size."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._relcast_scratch = path
    return back


def release(df: DataFrame) -> None:
    """Deletes the files of a table made by :func:`materialise` that is not read any more."""
    path = getattr(df, "_relcast_scratch", None)
    if path:
        fs, where = hadoop_path(df.sparkSession, path)
        fs.delete(where, True)
