"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidewatch") -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and Arrow enabled.

    On a cluster ``master`` stays ``None`` so the launcher decides; tests and the
    bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # lets the optimizer cut a per-corpus vocabulary (up to 5000 terms) map-side
        "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("TIDEWATCH_DRIVER_MEMORY", "16g"))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; a folder of our own is set only when the
    session has none and runs on one machine (tests).  Elsewhere a machine-local
    folder would be lost with its executor, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not configured:
        configured = os.path.join(os.environ.get("TMPDIR", "/tmp"), "tidewatch-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever the working folder
    (on a cluster the package is installed or sent with ``--py-files``; this changes nothing there)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
