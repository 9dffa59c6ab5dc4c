"""SparkSession helpers.

Library code never builds its own session: it takes the caller's. These helpers
exist for tests, ``bench.py`` and local runs. On a cluster the cluster's own
configuration wins; we only fill in values that are unset.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins/partition counts at runtime
# and splits skewed shuffle partitions; broadcast joins are only planned for
# sides Spark can size below the threshold.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "helixdf") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only when it is unset (local tests) do we create a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        # A machine-local folder would not survive an executor loss.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
    path = tempfile.mkdtemp(prefix="helixdf-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/helixdf-out/{uuid.uuid4().hex}/{name}"


_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind. Otherwise they stay until
    the driver collects its garbage, and the steps of an operator add up on disk."""
    before = spark.conf.get(_DROP, "false")
    spark.conf.set(_DROP, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP, before)
