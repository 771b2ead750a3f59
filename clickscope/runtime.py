"""Session construction and the shared checkpoint folder.

On a cluster the checkpoint folder is whatever ``spark.checkpoint.dir`` names (a shared
file system). If it is unset, a cluster session raises; a local[...] session, whose only process
is the driver, gets a folder under the local temp directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every clickscope job relies on; cluster size-dependent knobs are left to the caller.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "clickscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, sink tables and streaming checkpoints."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = sc.getCheckpointDir()
        except Exception:  # older API surface
            root = None
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="clickscope-ckpt-")  # one process: its own disk is the shared one
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def use_utc(spark: SparkSession) -> None:
    """Fixture dates and minute keys are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


__all__ = ["build_session", "checkpoint_root", "scratch_path", "use_utc", "BASE_CONF"]
