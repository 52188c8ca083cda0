"""Session helpers.

Library code never creates a session: every operator takes DataFrames. These
helpers are for tests, the bench and command-line jobs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on: UTC session time, AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast
# conversion from measured sizes).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested settings for a large cluster (applied by the cluster's own
# configuration, not by the library): shuffle partitions sized so a partition
# holds ~128-256 MB after AQE coalescing, 256 MB input splits, skew handling
# for joins and rebalanced writes, and broadcast only below a measured size.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "zonelake",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("ZONELAKE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint/scratch root: the session's ``spark.checkpoint.dir``. In a
    local session without one, a fresh temporary folder; on a cluster that
    would be a different disk for each executor, so it is an error there."""
    d = checkpoint_root(spark)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="zonelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint root for job outputs that must
    outlive an executor (streaming checkpoints, materialised stages)."""
    import uuid

    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


# AQE replaces a plan whose join result turns out empty by an empty
# relation; the ``observe`` nodes inside it are then gone and their metrics
# cannot be read. Jobs that report stage counts exclude that rule while they
# write (everything else in AQE stays on).
KEEP_OBSERVED_PLAN = {
    "spark.sql.adaptive.optimizer.excludedRules":
        "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation",
}


class scoped_conf:
    """Set session SQL settings for the duration of a ``with`` block and
    restore the previous values afterwards."""

    def __init__(self, spark: SparkSession, settings: dict):
        self.spark = spark
        self.settings = settings
        self.saved: dict = {}

    def __enter__(self):
        for k, v in self.settings.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False
