"""Session helpers.

On a cluster the session is created by the platform; library code only reads
settings from it. ``local_session`` is for tests and the bench script.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quarry") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by the session in ``spark.checkpoint.dir``.

    Only a session in local mode (one machine) may leave it unset: it then gets
    a scratch folder of its own. Elsewhere a machine-local folder would lose
    rows without an error, so the missing setting is an error.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not _single_machine(spark):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    try:  # RDD checkpoints too, where the session exposes its SparkContext
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # pragma: no cover - e.g. a remote (Connect) session
        pass
    return path


def _single_machine(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    import uuid

    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
