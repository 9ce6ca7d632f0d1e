"""Session and checkpoint-folder helpers.

Library code never creates its own session on a cluster; it uses the one it is
given. ``local_session`` is for tests, benchmarks and the command line.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "ringwise",
    advisory_partition_bytes: str | None = None,
    min_partition_bytes: str | None = None,
) -> SparkSession:
    """Local session for tests, benchmarks and the command line.

    ``advisory_partition_bytes`` / ``min_partition_bytes`` tune how far AQE
    merges small shuffle partitions (Spark defaults: 64m / 1m). Small data sets
    merge into one task per stage by default; smaller targets keep the cores busy.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RINGWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if advisory_partition_bytes:
        builder = builder.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory_partition_bytes)
    if min_partition_bytes:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", min_partition_bytes)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Uses ``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) when the
    cluster names one. Only a local-mode session without one gets a private
    temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
    root = tempfile.mkdtemp(prefix="ringwise-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the checkpoint root for one materialised result."""
    return f"{checkpoint_root(spark)}/ringwise/{label}-{uuid.uuid4().hex[:12]}"
