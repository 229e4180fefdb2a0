"""Session set-up shared by the library, the tests and the bench.

The library never assumes a local machine: scratch output (checkpoints, the
written warehouse of the registered queries) goes under the shared folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is absent, as
in a bare test session, is a private temporary folder created.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this package needs for correct results.
REQUIRED_CONF = {
    # All instants are compared and bucketed in UTC (date keys, peak hour).
    "spark.sql.session.timeZone": "UTC",
}

# Settings for plan quality at scale; applied by ``build_session`` only.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "encore", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the package's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(TUNING_CONF)
    conf.update(REQUIRED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on and make sure checkpoints work."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only if none is named."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            # A machine-local folder is not shared by the executors of a cluster.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (for example on HDFS or "
                               "object storage): checkpoints and scratch tables are written there")
        # Bare local session (tests): no shared folder is configured.
        named = tempfile.mkdtemp(prefix="encore-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique output location next to the checkpoints (shared storage)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/encore-out/{name}-{uuid.uuid4().hex[:12]}"


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme for python-side file access in tests."""
    return path[5:] if path.startswith("file:") else path
