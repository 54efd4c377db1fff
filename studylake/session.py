"""Session helpers: building a local session for tests/bench, and resolving
the shared checkpoint / staging folders from the running session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "studylake") -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own
    session instead; nothing here assumes local mode except the defaults."""
    master = master or os.environ.get("STUDYLAKE_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STUDYLAKE_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of its own with the settings of ``spark``, but for those given."""
    own = spark.newSession()
    for k, v in (spark.conf.getAll | settings).items():
        if own.conf.isModifiable(k) and own.conf.get(k, None) != v:
            own.conf.set(k, v)
    return own


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only when it is unset and the master is local
    (tests, bench) is a scratch folder created; on a cluster an unset value is
    an error, because a machine-local folder does not survive executor loss."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/...) before running keyed or staged jobs")
    local = tempfile.mkdtemp(prefix="studylake-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def warehouse_root(spark: SparkSession) -> str:
    """The one place where runs are published when the caller names none."""
    return os.path.join(spark.conf.get("studylake.warehouse.dir", None) or os.path.join(
        checkpoint_dir(spark), "studylake"), "warehouse")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written tables
    (staged clean output, warehouse runs). Each call gets a new run folder, so
    a path being read is never overwritten."""
    root = spark.conf.get("studylake.warehouse.dir", None) or os.path.join(
        checkpoint_dir(spark), "studylake")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
