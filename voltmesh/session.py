"""Session builder and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "voltmesh", cpus: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench; on a cluster the submitter's settings win."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if root is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="voltmesh-")
            context.setCheckpointDir(root)
    return root.rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created or removed."""
    return f"{shared_root(spark)}/voltmesh/{name}-{uuid.uuid4().hex}"
