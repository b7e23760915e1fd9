"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE coalesces the many small post-aggregate
# shuffle partitions and splits skewed ones at runtime; UTC keeps text/instant
# conversions reproducible across executors in different zones.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # RocksDB keeps streaming state (running totals, UV sets) off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # upload only the state changes at each commit, not whole snapshots
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # no read-before-write per state update just to count rows (a metric)
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


LOCAL_SHUFFLE_PARTITIONS = 8


def build_session(master: str | None = "local[8]", shuffle_partitions: int | None = None,
                  app_name: str = "eventide", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master=None`` leaves the master to spark-submit (cluster runs) and
    also leaves ``spark.sql.shuffle.partitions`` to it (builder options would
    override ``--conf``; so does a cluster master): size it to the widest shuffle's bytes / 128 MB; AQE
    then coalesces small partitions. Local masters default to 8.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions is None and master and is_local(master):
        shuffle_partitions = LOCAL_SHUFFLE_PARTITIONS
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """One JVM, whose temporary folder every task shares."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and committed tables.

    ``spark.checkpoint.dir`` names it. Where that is unset, a local master gets
    a fresh scratch folder; on a cluster it is an error, since executors and
    driver share no local folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="eventide-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: it is
    computed once however often it is used, and the planner knows its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
