"""Session settings and the shared scratch location.

Nothing here assumes a local machine: scratch output (stream checkpoints,
round-trip tables) lives under the folder the cluster names in
``spark.checkpoint.dir``. Only when that is unset (tests, laptops) do we
create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings we want on every session we build ourselves.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "eventflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local master may go without: there a private
    folder is made. On a cluster executors would not see such a folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="eventflow-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/eventflow/{name}-{uuid.uuid4().hex[:12]}"


def ensure_state_store(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB state store provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "") != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
