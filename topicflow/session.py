"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "topicflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and the RocksDB state store.

    Shuffle partitions are left to the caller: they depend on the cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    use_rocksdb(spark)
    return spark


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on disk (RocksDB), uploading only changes per batch."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder named in ``spark.checkpoint.dir``.

    Executors on other machines must see it, so a temporary folder of this machine
    is used only when the setting is absent and Spark runs in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="topicflow-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/topicflow/{name}-{uuid.uuid4().hex}"
