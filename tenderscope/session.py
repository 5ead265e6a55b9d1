"""Session helpers.

Library code never sets global configuration on a session it is handed;
``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "tenderscope") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # managed tables of local runs go to a scratch folder, not the cwd
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tenderscope-wh-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is set by the deployment and is read, never replaced.
    Only a local session without one (tests) gets a scratch folder; elsewhere
    an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        sc = None
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = (sc.getCheckpointDir() if sc is not None else None) or configured
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return (sc.getCheckpointDir() if sc is not None else None) or current
    if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tenderscope-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local
