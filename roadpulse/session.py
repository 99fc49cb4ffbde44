"""Spark session and shared-folder helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every roadpulse job relies on. Event times are naive wall-clock
# values, so the session clock is pinned to UTC; AQE re-plans joins and
# coalesces partitions from runtime statistics.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Static: a serving session runs dozens of distinct plans; keep their
    # generated classes instead of recompiling (default cache: 100 entries).
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


STATIC_SQL = {"spark.sql.codegen.cache.maxEntries"}


ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(app: str = "roadpulse", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None,
                rocksdb_state: bool = False) -> SparkSession:
    """Return a session configured for roadpulse.

    On a cluster, leave ``master`` unset and let spark-submit supply it;
    ``shuffle_partitions`` should then be sized so one shuffle partition
    holds roughly 128-256 MB (AQE coalesces the rest). ``rocksdb_state``
    keeps streaming state in RocksDB instead of the executor heap.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if rocksdb_state:
        # Streaming state off the JVM heap (many windows x sensors).
        conf.update(ROCKSDB_STATE)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate returns an existing session unchanged: apply SQL settings.
    for key, value in conf.items():
        if key.startswith("spark.sql.") and key not in STATIC_SQL:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set and the master is local (tests)
    is a fresh local folder created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="roadpulse-ckpt-"))
        base = sc.getCheckpointDir()
    return base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder for stream checkpoints and intermediate tables under the
    shared checkpoint root."""
    base = checkpoint_root(spark).rstrip("/")
    return f"{base}/roadpulse/{name}"
