"""Helpers that read (never own) the caller's SparkSession configuration."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared scratch area.

    This is the folder named by ``spark.checkpoint.dir``. A local-mode session
    without that setting uses a folder in its warehouse; on a cluster a missing
    setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # setCheckpointDir(x) adds a random child folder under x.
            return current.rsplit("/", 1)[0]
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every "
                "executor can reach"
            )
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared scratch area."""
    return f"{shared_dir(spark)}/adtally/{name}-{uuid.uuid4().hex}"


def unique_name(prefix: str) -> str:
    """A unique identifier for temp views and tables."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
