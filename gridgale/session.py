"""Session settings, and the shared folder where long jobs cut their lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Tables in buckets of the instant are joined on place and instant as they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    # Saves several JVM calls per column expression while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app_name: str = "gridgale", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; `settings` uses `__` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from `spark.checkpoint.dir`.

    Only a local master may go without it; there a scratch folder is made, since
    the one machine is the whole cluster, and removed with the session's process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="gridgale-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
        current = spark.sparkContext.getCheckpointDir()
    # Spark appends a folder of its own to what was set; results go next to it.
    return current.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet to the shared folder and go on from the copy.

    It survives lost executors, is computed once, and later plans can leave out columns
    and see its size.
    """
    path = shared_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
