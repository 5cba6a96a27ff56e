"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall-clock, ANSI stays on (so every
# lenient parse below is an explicit try_* call), AQE re-plans joins and
# coalesces/splits shuffle partitions from runtime statistics.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # streaming state (dedup keys) lives in RocksDB off-heap, not in the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "lavra", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in {**SESSION_DEFAULTS,
                       "spark.sql.shuffle.partitions": str(shuffle_partitions),
                       **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session time zone; text ↔ timestamp parsing depends on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local session (as in tests) gets a folder of
    its own, registered so that every later call agrees; a cluster session is
    refused, since its executors could not see such a folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="lavra-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared folder for one run."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/lavra/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["build_session", "use_utc", "shared_dir", "scratch_path", "SESSION_DEFAULTS"]
