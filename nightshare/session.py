"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "nightshare", master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """A session with the settings the package relies on; cluster settings win where they are given outside."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.files.maxPartitionBytes", "128m")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the folder all executors can see.

    ``spark.checkpoint.dir`` names it on a cluster. Only a local master may fall
    back to a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root()
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once where several branches of a plan need them, with sizes Spark knows."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@functools.cache
def _local_root() -> str:
    """One scratch folder of this process, removed when it ends; for local masters without the setting only."""
    root = tempfile.mkdtemp(prefix="nightshare-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root
