"""Session construction and shared-storage helpers.

Scratch output (versioned table rewrites, stream checkpoints, partitioned
landings) always goes under the shared folder named by ``spark.checkpoint.dir``.
On a cluster that setting must be provided by the platform; only a local
session (tests, the driver's local checks) gets a fresh temp folder when it is
unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Settings every job in this package relies on. AQE re-plans joins at runtime
# (broadcast conversion from real sizes, skew splitting, partition coalescing).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalescing works on shuffle *bytes*; JSON building/parsing stages are CPU
    # heavy per byte, so keep partitions down to 256 KB rather than the 1 MB
    # default. At cluster scale partitions are far larger and this is inert.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key also where an aggregate on the join's own partitioning follows; the
    # extra shuffle then carries that aggregate's partial rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ferrum", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Timestamp parsing/formatting in this package assumes a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The shared folder for job output that must survive executor loss."""
    jsc = spark.sparkContext._jsc  # noqa: SLF001 - public Java API, no Python getter
    current = jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder for its output")
    local = tempfile.mkdtemp(prefix="ferrum-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()  # noqa: SLF001


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one job's output."""
    root = shared_root(spark).rstrip("/")
    return f"{root}/ferrum/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
